"""BPE encoding and decoding in batched numpy merge rounds.

The symbols of many words lie in one flat array. In each round the lowest-ranked pair of every word is found by binary
search over the sorted pair keys and merged wherever it occurs, until no word has a pair left. Words come out of the
library's byte-level pre-tokenisation; a bounded cache keeps what was encoded, so that a frequent word is merged once.

Defined results: a null text counts as empty and has no ids; the special token's string in a text is that one id; a
repeated row is encoded like any other; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import count, islice, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks

CACHE_WORDS = 250_000  # entries kept per Python worker and cache
# The byte-level pattern of the public vocabulary. Below SAFE the two regex engines agree on all classes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SAFE = "԰"
NONE = np.iinfo(np.int32).max


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    chars = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [chars[b] for b in range(256)]


class BpeModel:
    """Vocabulary and merges of a byte-level tokenizer file, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = 1 + max([*vocab.values(), *self.special.values()])
        alphabet = byte_alphabet()
        self.byte_ids = np.array([vocab[c] for c in alphabet], np.int32)
        to_byte = {c: b for b, c in enumerate(alphabet)}
        self.token_bytes = [b""] * self.size
        for token, i in [*vocab.items(), *self.special.items()]:
            self.token_bytes[i] = bytes(to_byte[c] for c in token)
        pairs = [p if isinstance(p, list) else p.split(" ") for p in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = made  # by rank
        self.byte_ranks = self.pair_ranks(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256))  # of two bytes

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of every word (not empty) as little-endian unsigned 32-bit numbers."""
        if not words:
            return []
        ids, counts = self.encode_bytes(np.frombuffer(b"".join(words), np.uint8), np.fromiter(map(len, words), np.int64, len(words)))
        flat, ends = ids.tobytes(), np.cumsum(counts) * 4
        return [flat[a:b] for a, b in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist(), strict=True)]

    def encode_bytes(self, raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, ids per word) of words of the given lengths (not 0) that lie in a row."""
        if not len(lengths):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        symbols = self.byte_ids[raw]
        owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        # of the pair that begins at each symbol
        ranks = np.append(self.byte_ranks[raw[:-1].astype(np.int32) * 256 + raw[1:]], np.int32(NONE))
        ranks[np.cumsum(lengths) - 1] = NONE
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            best = np.minimum.reduceat(ranks, starts)
            spans = np.diff(np.append(starts, len(symbols)))
            best_here = np.repeat(best, spans)
            finished = best_here == NONE
            if finished.any():
                done.append((owner[finished], symbols[finished]))
                left = ~finished
                symbols, owner, ranks, best_here = symbols[left], owner[left], ranks[left], best_here[left]
                if not len(symbols):
                    break
            at = np.flatnonzero(ranks == best_here)
            # of overlapping occurrences (one after the other) every second is taken, from the left
            fresh = np.concatenate([[True], np.diff(at) > 1])
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0]
            symbols[at] = self.made[ranks[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            new_at = at - np.arange(len(at))
            symbols, owner, ranks = symbols[keep], owner[keep], ranks[keep]
            stale = np.concatenate([new_at, new_at[new_at > 0] - 1])
            ranks[stale] = NONE
            stale = stale[stale < len(symbols) - 1]
            stale = stale[owner[stale] == owner[stale + 1]]
            ranks[stale] = self.pair_ranks(symbols[stale], symbols[stale + 1])
        owners = np.concatenate([o for o, _ in done])
        order = np.argsort(owners, kind="stable")
        return np.concatenate([s for _, s in done])[order].astype("<u4"), np.bincount(owners, minlength=len(lengths))


class Encoder:
    """Texts to rendered pieces. A piece is what lies between two single spaces, with the space before it.

    No word of the pattern reaches across such a space, so pieces are encoded and cached one by one; a text with further
    white space next to a space is split by the pattern as a whole. A full cache keeps what came up more than once.
    """

    def __init__(self, model: BpeModel, render: Callable[[bytes], object], cache_words: int = CACHE_WORDS):
        from tokenizers import pre_tokenizers

        self.model, self.render, self.limit = model, render, cache_words
        self.pattern = regex.compile(PATTERN)
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.words: dict[str, bytes] = {}  # word of the pattern -> ids
        self.pieces: dict[str, object] = {}  # piece after a space -> rendered
        self.heads: dict[str, object] = {}  # piece at the start of a text -> rendered
        self.specials = regex.compile("|".join(map(regex.escape, model.special))) if model.special else None

    def split(self, text: str) -> list[str]:
        if text.isascii() or max(text) < SAFE:
            return self.pattern.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def segments(self, text: str) -> list[tuple[str, list[str] | int]]:
        """A text as lists of pieces ("pieces") with the special ids ("id") between them, in order."""
        if self.specials is None or not any(s in text for s in self.model.special):
            return [("pieces", text.split(" "))] if text else []
        out, start = [], 0
        for m in self.specials.finditer(text):
            if m.start() > start:
                out.append(("pieces", text[start : m.start()].split(" ")))
            out.append(("id", self.model.special[m.group()]))
            start = m.end()
        if start < len(text):
            out.append(("pieces", text[start:].split(" ")))
        return out

    def learn_words(self, words: set[str]) -> None:
        todo = [w for w in words if w not in self.words]
        self.words.update(zip(todo, self.model.encode_words([w.encode() for w in todo]), strict=True))

    def learn_pieces(self, pieces: set[str]) -> None:
        plain = [p for p in pieces if p.isascii() and p.isalpha()]
        ids = self.model.encode_words([b" " + p.encode() for p in plain])
        self.pieces.update(zip(plain, map(self.render, ids), strict=True))
        mixed = list(pieces.difference(plain))
        if not mixed:
            return
        flat = self.split(" " + " ".join(mixed))  # only the first word of a piece begins with a space
        self.learn_words(set(flat))
        starts = [i for i, w in enumerate(flat) if w[0] == " "]
        ids = list(map(self.words.__getitem__, flat))
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        bounds = [0, *ends[np.array(starts[1:], np.int64) - 1].tolist(), int(ends[-1])]
        whole = b"".join(ids)
        self.pieces.update(zip(mixed, [self.render(whole[a:b]) for a, b in pairwise(bounds)], strict=True))

    def encode(self, texts: list[str]) -> Iterator[list]:
        """The rendered pieces of every text, in order."""
        plans = [self.segments(t) for t in texts]
        rest, heads, words = set(), set(), set()
        for plan in plans:
            for kind, parts in plan:
                if kind == "pieces":
                    heads.add(parts[0])
                    rest.update(parts[1:])
        fresh = rest.difference(self.pieces)
        edged = {p for p in fresh if p != p.strip() or not p}
        edged_heads = {p for p in heads.difference(self.heads) if p != p.strip() or not p}
        if edged or edged_heads:
            for plan in plans:
                for i, (kind, parts) in enumerate(plan):
                    if kind == "pieces" and (parts[0] in edged_heads or not edged.isdisjoint(parts)):
                        plan[i] = ("words", self.split(" ".join(parts)))
                        words.update(plan[i][1])
            rest -= edged
            heads -= edged_heads
        fresh -= edged
        if len(self.pieces) + len(fresh) > self.limit:
            self.pieces = {p: self.pieces[p] for p in rest.difference(fresh)}
        if len(self.heads) > self.limit:
            self.heads = {}
        if len(self.words) > self.limit:
            self.words = {}
        self.learn_pieces(fresh)
        new_heads = {p: self.split(p) for p in heads if p not in self.heads}
        self.learn_words(words.union(*new_heads.values()))
        ids_of = self.words.__getitem__
        self.heads.update((p, self.render(b"".join(map(ids_of, ws)))) for p, ws in new_heads.items())
        piece_of = self.pieces.__getitem__
        for plan in plans:
            out: list = []
            for kind, parts in plan:
                if kind == "pieces":
                    out.append(self.heads[parts[0]])
                    out += map(piece_of, parts[1:])
                elif kind == "words":
                    out.append(self.render(b"".join(map(ids_of, parts))))
                else:
                    out.append(self.render(np.array([parts], "<u4").tobytes()))
            yield out


class IdEncoder(Encoder):
    """Texts to their ids alone. Pieces and words are numbered in one look-up each, and a number stands for a stretch of one
    array of ids, so the ids of all texts are gathered at once. When it is full, what the texts before held is kept.
    """

    def __init__(self, model: BpeModel, cache_words: int = CACHE_WORDS):
        super().__init__(model, bytes, cache_words)
        letters = [*range(0x41, 0x5B), *range(0x61, 0x7B), 0x20]
        self.letter = np.zeros(256, bool)
        self.letter[letters] = True
        self.number = count()
        self.words = defaultdict(self.number.__next__)
        self.pieces = defaultdict(self.number.__next__)
        special = np.array([*model.special.values()], "<u4")
        self.special = {int(i): next(self.number) for i in special}
        self.ids = special
        self.starts = np.arange(len(special))
        self.sizes = np.ones(len(special), np.int64)
        self.edged = np.zeros(len(special), bool)  # pieces that the pattern doesn't keep whole
        self.last = np.zeros(0, np.int64)

    def shrink(self) -> None:
        """Keep special ids and the numbers of the last texts, in their order."""
        kept = np.zeros(len(self.sizes), bool)
        kept[self.last] = True
        kept[: len(self.special)] = True
        new = (np.cumsum(kept) - 1).tolist()
        here = kept.tolist()
        self.number = count(int(kept.sum()))
        self.words = defaultdict(self.number.__next__, {k: new[v] for k, v in self.words.items() if here[v]})
        self.pieces = defaultdict(self.number.__next__, {k: new[v] for k, v in self.pieces.items() if here[v]})
        numbers = np.flatnonzero(kept)
        self.ids = self.gathered(numbers)
        self.sizes, self.edged = self.sizes[numbers], self.edged[numbers]
        self.starts = np.cumsum(self.sizes) - self.sizes

    def gathered(self, numbers: np.ndarray) -> np.ndarray:
        """The ids that the numbers stand for, one after the other."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(self.starts[numbers] - ends + sizes, sizes) + np.arange(int(sizes.sum()))]

    def grow(self) -> None:
        """Make room for numbers given since the last time."""
        more = len(self.words) + len(self.pieces) + len(self.special) - len(self.sizes)
        self.sizes = np.append(self.sizes, np.zeros(more, np.int64))
        self.starts = np.append(self.starts, np.zeros(more, np.int64))
        self.edged = np.append(self.edged, np.zeros(more, bool))

    def keep(self, numbers: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.starts[numbers] = len(self.ids) + np.cumsum(sizes) - sizes
        self.sizes[numbers] = sizes
        self.ids = np.concatenate([self.ids, ids])

    def learn_words(self, known: int) -> None:
        """Ids of all words but the first ``known``."""
        more = len(self.words) - known
        words = [w.encode() for w in islice(reversed(self.words), more)]
        numbers = np.fromiter(islice(reversed(self.words.values()), more), np.int64, more)
        lengths = np.fromiter(map(len, words), np.int64, more)
        self.grow()
        self.keep(numbers, *self.model.encode_bytes(np.frombuffer(b"".join(words), np.uint8), lengths))

    def learn_pieces(self, known: int) -> list[str]:
        """Ids of those of all pieces but the first ``known`` that are letters only; the others, with ids by ``learn_mixed``."""
        more = len(self.pieces) - known
        pieces = list(islice(reversed(self.pieces), more))
        numbers = np.fromiter(islice(reversed(self.pieces.values()), more), np.int64, more)
        if not more:
            return []
        raw = np.frombuffer((" " + " ".join(pieces)).encode(), np.uint8)
        starts = np.flatnonzero(raw == 0x20)  # no piece holds a space
        lengths = np.diff(np.append(starts, len(raw)))
        plain = np.logical_and.reduceat(self.letter[raw], starts) & (lengths > 1)
        self.keep(numbers[plain], *self.model.encode_bytes(raw[np.repeat(plain, lengths)], lengths[plain]))
        return [pieces[i] for i in np.flatnonzero(~plain).tolist()]

    def learn_mixed(self, mixed: list[str]) -> None:
        known = len(self.words)
        flat = self.split(" " + " ".join(mixed))  # only the first word of a piece begins with a space
        words = np.fromiter(map(self.words.__getitem__, flat), np.int64, len(flat))
        self.learn_words(known)
        starts = [i for i, w in enumerate(flat) if w[0] == " "]
        numbers = np.fromiter(map(self.pieces.__getitem__, mixed), np.int64, len(mixed))
        self.keep(numbers, self.gathered(words), np.add.reduceat(self.sizes[words], starts))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of every text as little-endian unsigned 32-bit numbers."""
        if len(self.sizes) > self.limit:
            self.shrink()
        known_words, known_pieces = len(self.words), len(self.pieces)
        word_of, piece_of = self.words.__getitem__, self.pieces.__getitem__
        numbers: list[int] = []
        segments: list[list[str]] = []
        bounds: list[int] = []  # of the segments, in numbers
        ends: list[int] = []  # of the texts, in numbers
        for text in texts:
            for kind, parts in self.segments(text):
                if kind == "id":
                    numbers.append(self.special[parts])
                    continue
                segments.append(parts)
                bounds.append(len(numbers))
                numbers += map(word_of, self.split(parts[0]))
                numbers += map(piece_of, islice(parts, 1, None))
                bounds.append(len(numbers))
            ends.append(len(numbers))
        self.grow()
        mixed = self.learn_pieces(known_pieces)
        edged = [p for p in mixed if p != p.strip() or not p]
        self.edged[[*map(piece_of, edged)]] = True
        flat = np.fromiter(numbers, np.int64, len(numbers))
        inside = np.append(np.cumsum(self.edged[flat]), 0)  # at -1: none before
        first, last = np.array(bounds, np.int64).reshape(-1, 2).T - 1
        again = np.flatnonzero((last > first) & (inside[last] > inside[first]))
        heads = [i for i, parts in enumerate(segments) if parts[0] != parts[0].strip() or not parts[0]]
        found: list[np.ndarray] = []
        at, shifts = 0, np.zeros(len(numbers) + 1, np.int64)
        for i in sorted({*again.tolist(), *heads}):  # split by the pattern as a whole
            a, b = bounds[2 * i : 2 * i + 2]
            words = [*map(word_of, self.split(" ".join(segments[i])))]
            found += [flat[at:a], np.array(words, np.int64)]
            at = b
            shifts[b] = len(words) - (b - a)
        flat = np.concatenate([*found, flat[at:]])
        self.learn_words(known_words)
        if mixed := [p for p in mixed if not self.edged[piece_of(p)]]:
            self.learn_mixed(mixed)
        self.last = flat
        ids = self.gathered(flat).tobytes()
        places = np.append(0, np.cumsum(self.sizes[flat]) * 4)
        ends = places[np.array(ends, np.int64) + np.cumsum(shifts)[ends]].tolist() if ends else []
        for a, b in pairwise([0, *ends]):
            yield ids[a:b]


@lru_cache(maxsize=2)
def model_of(path: str) -> BpeModel:
    return BpeModel(path)


@lru_cache(maxsize=2)
def id_encoder(path: str) -> IdEncoder:
    """Encoder of a Python worker for ids alone."""
    return IdEncoder(model_of(path), 400_000)


@lru_cache(maxsize=2)
def text_encoder(path: str) -> Encoder:
    """Encoder of a Python worker whose pieces are (count, ids in decimal with a comma before each, decoded bytes)."""
    token_bytes = model_of(path).token_bytes

    def render(ids: bytes) -> tuple[int, str, bytes]:
        values = memoryview(ids).cast("I").tolist()
        return len(values), "".join([f",{i}" for i in values]), b"".join([token_bytes[i] for i in values])

    return Encoder(model_of(path), render)


def encode_ids(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array) of every text."""

    def task(batches):
        encoder = id_encoder(path)
        for batch, texts in chunks(batches, "text"):
            ids = [np.frombuffer(p, "<u4").astype(np.int32) for p in encoder.encode([t or "" for t in texts])]
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        task, f"id {df.schema[id_col].dataType.simpleString()}, ids array<int>"
    )


def decode_ids(df: DataFrame, path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of every id array; bytes that are no text become the replacement character. Null ids count as none."""

    def task(batches):
        token_bytes = model_of(path).token_bytes
        for batch in batches:
            texts = [
                b"".join([token_bytes[i] for i in ids or []]).decode("utf-8", "replace")
                for ids in batch.column(1).to_pylist()
            ]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    return df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(
        task, f"id {df.schema[id_col].dataType.simpleString()}, text string"
    )


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text encoded and decoded again: (id, n_tokens, ids_sha256, decoded_sha256).

    ids_sha256 is over the decimal ids joined by commas, decoded_sha256 over the decoded text in UTF-8.
    """

    def task(batches):
        encoder = text_encoder(path)
        for batch, texts in chunks(batches, "text"):
            counts, ids, decoded = [], [], []
            for parts in encoder.encode([t or "" for t in texts]):
                counts.append(sum([p[0] for p in parts]))
                ids.append(hashlib.sha256("".join([p[1] for p in parts])[1:].encode()).hexdigest())
                raw = b"".join([p[2] for p in parts])
                decoded.append(hashlib.sha256(raw.decode("utf-8", "replace").encode()).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            yield pa.record_batch(columns, ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        task, f"id {df.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
