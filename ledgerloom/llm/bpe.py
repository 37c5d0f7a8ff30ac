"""BPE encoding by backtracking over longest token matches, and decoding by an offset table.

The tokens that occur in a word are found in one Aho-Corasick pass. The encoder then goes through
the word with the longest token at each place, keeps it if the merges would leave it beside the
token before it, tries shorter ones otherwise, and steps back when none fits; a place that leads
nowhere is never visited again, so the work is linear in the word. Neighbours are compatible if
undoing their merges in reverse order meets no pair across their border that would have been merged
earlier; answers are kept in a table.

NULL text is empty and gives no tokens. Rows, repeated ones too, are handled one by one and all
other columns pass through.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.arrays import steps
from ledgerloom.llm.common import held, share, tidy

#: Text of one step: decoding it takes some fifty times as much memory.
STEP = 512 << 10
#: Strings between spaces whose ids a worker keeps at hand: the younger half and the older half. Of words, a quarter as many.
KNOWN = 160_000
#: Fixed values of the tokenizer: what counts as one word, and its word end mark.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
END = "</w>"


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tables:
    """What encoder and decoder need of a tokenizer file; small and bounded by its vocabulary.

    A token is held as a string of letters 0-255 for its bytes; the last letter of a word is 256 higher.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, letters = whole["model"], _byte_letters()
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        vocab = {t: i for t, i in model["vocab"].items() if t not in self.special}
        number = max([*vocab.values(), *self.special.values()]) + 1

        def inner(token: str) -> str:
            closed = token.endswith(END) and token != END
            body = [letters[c] for c in (token.removesuffix(END) if closed else token)]
            return "".join(map(chr, body[:-1])) + chr(body[-1] + 256 * closed)

        self._encoder: Encoder | None = None
        self.strings = [""] * number
        for token, i in vocab.items():
            self.strings[i] = inner(token)
        self.sizes = [len(s) for s in self.strings]
        self.rank, self.pair, self.split = [-1] * number, {}, [(i, i) for i in range(number)]
        for r, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            made = vocab[left + right]
            if self.rank[made] < 0:
                self.rank[made], self.split[made] = r, (vocab[left], vocab[right])
            self.pair[vocab[left], vocab[right]] = (r, made)
        self.base = {s: i for i, s in enumerate(self.strings) if len(s) == 1}
        usable = [i for i, s in enumerate(self.strings) if s and (len(s) == 1 or self._merged(s) == [i])]
        self.usable = usable
        known = {self.strings[i]: i for i in usable}
        # The longest usable token that starts a token and is shorter.
        self.shorter = [-1] * number
        for i in usable:
            s = self.strings[i]
            self.shorter[i] = next((known[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in known), -1)
        # Decoding writes every token followed by a space.
        by_id = {i: t for t, i in (model["vocab"] | self.special).items()}
        pieces = [(by_id.get(i, "") + " ").encode() for i in range(number)]
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        self.blob = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    def encoder(self) -> Encoder:
        """An encoder that lives as long as these tables do in a worker."""
        if self._encoder is None:
            self._encoder = Encoder(self)
        return self._encoder

    def _merged(self, string: str) -> list[int]:
        """Plain merging, lowest rank first: only to tell which tokens can come out at all."""
        ids = [self.base[c] for c in string]
        while len(ids) > 1:
            best = min(((self.pair[p][0], k) for k, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.pair), default=None)
            if best is None:
                break
            pair, made, out, k = (ids[best[1]], ids[best[1] + 1]), self.pair[ids[best[1]], ids[best[1] + 1]][1], [], 0
            while k < len(ids):
                hit = tuple(ids[k:k + 2]) == pair
                out.append(made if hit else ids[k])
                k += 1 + hit
            ids = out
        return ids


class _Memory(dict):
    """Answers of `make`: at most `size` in two generations, the older one dropped as the younger one fills."""

    def __init__(self, make: Callable[[str], bytes], size: int) -> None:
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.size // 2:
            self.old = dict(self)
            self.clear()
        got = self.old.get(key)
        self[key] = got = self.make(key) if got is None else got
        return got


class Encoder:
    """Encodes texts with the tables; a Python worker keeps it for its next tasks."""

    def __init__(self, tables: Tables) -> None:
        import ahocorasick
        import regex

        self.t = tables
        self.machine = ahocorasick.Automaton()
        for i in tables.usable:
            self.machine.add_word(tables.strings[i], i)
        self.machine.make_automaton()
        self.compatible: dict[int, bool] = {}
        self.words, self.runs = _Memory(self._word, KNOWN // 4), _Memory(self._run, KNOWN)
        self.find = regex.compile(WORD).findall
        self.marks = regex.compile("|".join(regex.escape(s) for s in sorted(tables.special, key=len, reverse=True))) if tables.special else None
        # Spaces to Python but not to the tokenizer.
        self.odd = regex.compile("[\x1c-\x1f]").search

    def beside(self, left: int, right: int) -> bool:
        """Whether merging leaves the two tokens next to each other."""
        if len(self.compatible) >= KNOWN:
            self.compatible.clear()
        found = self.compatible[left << 32 | right] = self._undo(left, right)
        return found

    def _undo(self, left: int, right: int) -> bool:
        """Undo merges on both sides of the border, latest first, and look for an earlier merge across it."""
        rank, split, pair = self.t.rank, self.t.split, self.t.pair
        before = float("inf")
        while True:
            across = pair.get((left, right))
            if across is not None and across[0] < before:
                return False
            if rank[left] < 0 and rank[right] < 0:
                return True
            # Of equal merges the left one is made first, so the right one is undone first.
            if rank[left] > rank[right]:
                before, left = rank[left], split[left][1]
            else:
                before, right = rank[right] + 1, split[right][0]

    def word(self, word: str) -> list[int]:
        """Ids of one word, a string as in the tables."""
        size, sizes, shorter, known = len(word), self.t.sizes, self.t.shorter, self.compatible
        longest = [-1] * size
        for end, token in self.machine.iter(word):
            longest[end - sizes[token] + 1] = token  # ends ascend, so the longest stays
        token, at, out, open_ = longest[0], sizes[longest[0]], [], None
        if at == size:
            return [token]
        before, at = -1, 0
        while True:
            end = at + sizes[token]
            if open_ is None or open_[end]:
                fits = before < 0 or known.get(before << 32 | token)
                if fits is None:
                    fits = self.beside(before, token)
                if fits:
                    out.append(token)
                    if end == size:
                        return out
                    at, before, token = end, token, longest[end]
                    continue
            token = shorter[token]
            while token < 0:
                # Nothing fits here: this place is closed, and the token before it is to be shorter.
                open_ = open_ or bytearray([1]) * (size + 1)
                open_[at] = 0
                last = out.pop()
                at, before, token = at - sizes[last], out[-1] if out else -1, shorter[last]

    def ids(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit numbers."""
        if self.marks is None or "<" not in text:
            return self._plain(text)
        out, done = [], 0
        for hit in self.marks.finditer(text):
            out += [self._plain(text[done:hit.start()]), self.t.special[hit.group()].to_bytes(4, "little")]
            done = hit.end()
        return b"".join([*out, self._plain(text[done:])])

    def _plain(self, text: str) -> bytes:
        if text.isascii():
            text = text.lower()
        else:
            text = unicodedata.normalize("NFC", text)
            # Letter by letter: the final form of sigma is no lower case here.
            text = text.lower() if "Σ" not in text else "".join(c.lower() for c in text)
        if self.odd(text):
            return self._run(text)
        # Words never cross a space, so what lies between two spaces can be looked up whole.
        runs = self.runs
        return b"".join([runs[r] for r in text.split()])

    def _run(self, text: str) -> bytes:
        words = self.words
        return b"".join([words[w] for w in self.find(text)])

    def _word(self, word: str) -> bytes:
        data = word.encode().decode("latin-1")
        return np.array(self.word(data[:-1] + chr(ord(data[-1]) + 256)), dtype="<u4").tobytes()


def decode(ids: np.ndarray, offsets: np.ndarray, blob: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the tokens, each followed by a space, and where each ends."""
    sizes = offsets[ids + 1] - offsets[ids]
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(offsets[ids] - (ends - sizes), sizes)
    return blob[at], ends


def _decoded(packed: list[bytes], offsets: np.ndarray, blob: np.ndarray) -> list[str]:
    """What the ids of each text decode to."""
    ids = np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int64)
    whole, ends = decode(ids, offsets, blob)
    whole, ends = whole.tobytes(), np.concatenate([[0], ends])
    border = ends[np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])])]
    return [whole[i:max(i, j - 1)].decode() for i, j in zip(border[:-1], border[1:], strict=True)]


def tokenize(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`docs` with n_tokens, `ids` (little-endian 32-bit numbers) and `decoded`, the text that the ids decode to."""
    shared = share(docs.sparkSession, Tables(path))
    added = pa.schema([("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])
    rest = [c for c in docs.columns if c.lower() not in added.names]
    plain = docs.select(*[F.col(f"`{c}`") for c in rest])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = held(shared)
        encoder = tables.encoder()
        for part, texts in steps(batches, text, STEP):
            packed = [encoder.ids(t.decode()) for t in texts]
            columns = [[len(p) // 4 for p in packed], packed, _decoded(packed, tables.offsets, tables.blob)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *(pa.array(c, f.type) for c, f in zip(columns, added, strict=True))], names=[*part.schema.names, *added.names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(tidy(run), f"{fields}, n_tokens long, ids binary, decoded string")
