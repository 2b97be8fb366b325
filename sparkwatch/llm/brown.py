"""Language-model scoring with class-based n-grams.

Words are counted over the whole training corpus. Classes are made in two steps. First every word belongs to a clustering
unit: each of the most frequent words is a unit of its own, all others are dealt to units by their form (ending and length).
Exchange clustering moves units between classes while that raises the likelihood of the class bigrams. Then every training
word that is no unit of its own, however rare, leaves its form and joins the class whose neighbours are likeliest to stand where its
own stand: the units before and after each of its sightings, found in the pass that counts the units' bigrams, go to one place,
where they are summed by class and judged. Class
bigrams are counted anew with the class of every word; only words that training texts do not hold are classed by form. A
text then has the probability

    product of P(class_i | class_{i-1}) * P(word_i | class_i)

with class transitions smoothed by addition, and word emissions by absolute discounting: a word seen c times in a class of n
tokens has (c - D) / n, one not seen D / n. Texts begin after an end and close with one.

The unit table is bounded by ``units`` squared whatever the corpus; counts and classes of the ``head`` most frequent words are
broadcast. All further words are joined: a text sends one row per token that the head does not hold, and its path of classes
(a byte per token) is completed with what comes back. Words are told apart by their 64-bit hash. No word outside the head holds
more than 1 / head of all tokens, no word with form more than 1 / own units of them, so no key is hot.

Defined results: a null or empty text is one end token; repeated rows count each; without training rows the base is that of
one unknown type and the model is uniform; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import count, islice, pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, stored

END = "\n"  # no word holds it
OWN_UNITS = 768
FORM_UNITS = 256
HEAD = 1 << 18
CACHE_WORDS = 300_000
HELD = 1 << 20  # sightings of words that a task gathers or judges at once
DISCOUNT = 0.5
ADDED = 0.05  # to class transitions
PRIOR = 100.0  # sightings of neighbours at large, added to those of a class


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 8) - (1 << 63)


def word_hashes(words) -> np.ndarray:
    """word_hash of every word."""
    digests = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(8)), np.uint64, len(words))
    return (digests ^ np.uint64(1 << 63)).view(np.int64)


END_HASH = word_hash(END.encode())


def form(word: bytes) -> int:
    """Unit of form: a hash of the ending and the length, capped."""
    return xxhash.xxh64_intdigest(word[-3:] + bytes([min(len(word), 12)]), 4) % FORM_UNITS


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, c) of every distinct token, ends included; each task sums up before the shuffle."""

    def task(batches):
        counts: Counter = Counter()
        for _, part in chunks(batches, "text"):
            for text in part:
                counts.update((text or b"").lower().split())
            counts[END.encode()] += len(part)
            if len(counts) > 400_000:
                yield rows(counts)
                counts = Counter()
        if counts:
            yield rows(counts)

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.record_batch([pa.array(word_hashes(counts)), pa.array(counts.values(), pa.int64())], ["h", "c"])

    return texts.mapInArrow(task, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


@dataclass
class Head:
    """The most frequent words by hash: their counts, and a unit for the first of them. Unit 0 is the end."""

    hashes: np.ndarray  # sorted
    counts: np.ndarray
    units: np.ndarray  # -1: by form
    classes: np.ndarray | None = None  # once they are known

    @classmethod
    def of(cls, counts: DataFrame, size: int) -> Head:
        top = counts.orderBy(F.desc("c"), "h").limit(size).toArrow()
        hashes, c = top.column("h").to_numpy(), top.column("c").to_numpy()
        rank = np.lexsort((hashes, -c))
        units = np.full(len(hashes), -1)
        inner = rank[hashes[rank] != END_HASH][: OWN_UNITS - 1]
        units[inner] = np.arange(1, len(inner) + 1)
        units[hashes == END_HASH] = 0
        order = np.argsort(hashes)
        return cls(hashes[order], c[order], units[order])

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of hashes in the head, -1 where they are not in it."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)


class Forms(dict):
    """Units of form by (ending, length); each is hashed once."""

    def __missing__(self, key: tuple[bytes, int]) -> int:
        ending, length = key
        self[key] = unit = form(ending.rjust(length, b" "))
        return unit


class Lexicon:
    """Numbers of the words of a worker, with what is known of each; starts anew when it is full."""

    def __init__(self, head: Head):
        self.head = head
        self.clear()

    def clear(self) -> None:
        self.number: defaultdict[bytes, int] = defaultdict(count().__next__)  # a new word gets the next number
        self.forms = Forms()
        self.hashes = np.zeros(0, np.int64)
        self.at = np.zeros(0, np.int64)  # in the head
        self.units = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)  # 0: not in the head

    def full(self) -> bool:
        return len(self.number) > CACHE_WORDS

    def codes(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        if self.full():
            self.clear()
        old = len(self.number)
        get = self.number.__getitem__
        coded = [np.fromiter(map(get, words), np.int64, len(words)) for words in texts]
        fresh = list(islice(reversed(self.number), len(self.number) - old))[::-1]
        if fresh:
            hashes = word_hashes(fresh)
            at = self.head.find(hashes)
            units = np.where(at >= 0, self.head.units[at], -1) if len(self.head.hashes) else at
            loose = np.flatnonzero(units < 0)
            forms = self.forms
            words = [*map(fresh.__getitem__, loose.tolist())]
            capped = np.minimum(np.fromiter(map(len, words), np.int64, len(words)), 12).tolist()
            keys = zip([w[-3:] for w in words], capped, strict=True)
            units[loose] = OWN_UNITS + np.fromiter(map(forms.__getitem__, keys), np.int64, len(words))
            counts = np.where(at >= 0, self.head.counts[at], 0) if len(self.head.hashes) else np.zeros(len(at), np.int64)
            self.hashes = np.concatenate([self.hashes, hashes])
            self.at = np.concatenate([self.at, at])
            self.units = np.concatenate([self.units, units])
            self.counts = np.concatenate([self.counts, counts])
        return coded

    def classes(self, member: np.ndarray) -> np.ndarray:
        """Class of every word: its own where the head has one, else that of its unit."""
        out = member[self.units]
        inside = np.flatnonzero(self.at >= 0)
        out[inside] = self.head.classes[self.at[inside]]
        return out


def inner_places(coded: list[np.ndarray]) -> np.ndarray:
    """Where the tokens stand when texts are laid in a row, with an end before the first one and after each: a mask."""
    ends = np.cumsum([len(c) + 1 for c in coded])
    inner = np.ones(int(ends[-1]) + 1, bool)
    inner[0] = False
    inner[ends] = False
    return inner


def summed_pairs(pairs: DataFrame, size: int) -> np.ndarray:
    """(pair, n) of all tasks, added up in a matrix of fixed size."""
    found = pairs.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size, np.int64)
    out[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(size, size)


def gain(n: np.ndarray) -> np.ndarray:
    """n log n, the term of a count in the likelihood."""
    return np.where(n > 0, n * np.log(np.maximum(n, 1)), 0.0)


def exchange(bigrams: np.ndarray, classes: int, rounds: int) -> np.ndarray:
    """Class of every unit. The end keeps class 0 for itself; each other unit in turn moves to its best class."""
    units = len(bigrams)
    counts = bigrams.sum(axis=1)
    order = np.argsort(-counts, kind="stable")
    order = order[(order != 0) & (counts[order] > 0)]
    member = np.full(units, classes - 1)
    member[order] = 1 + np.arange(len(order)) % (classes - 1)
    member[0] = 0
    one = np.zeros((units, classes))
    one[np.arange(units), member] = 1
    table = one.T @ bigrams @ one
    own = one.T @ counts
    for _ in range(rounds):
        moved = 0
        for u in order.tolist():
            here = member[u]
            after, before = bigrams[u] @ one, bigrams[:, u] @ one  # class counts around the unit
            itself = bigrams[u, u]
            after[here] -= itself
            before[here] -= itself
            table[here] -= after
            table[:, here] -= before
            table[here, here] -= itself
            own[here] -= counts[u]
            # what joining each class changes: its row, its column, the corner they share, its size
            rows = (gain(table + after) - gain(table)).sum(axis=1)
            columns = (gain(table + before[:, None]) - gain(table)).sum(axis=0)
            diagonal = np.diag(table)
            twice = gain(diagonal + after) + gain(diagonal + before) - gain(diagonal) - gain(diagonal + after + before + itself)
            change = rows + columns - twice - 2 * (gain(own + counts[u]) - gain(own))
            change[0] = -np.inf
            best = int(np.argmax(change))
            if change[best] <= change[here] + 1e-9:
                best = here
            table[best] += after
            table[:, best] += before
            table[best, best] += itself
            own[best] += counts[u]
            if best != here:
                one[u, here], one[u, best], member[u] = 0, 1, best
                moved += 1
        if moved <= len(order) // 200:
            break
    return member


def surroundings(texts: DataFrame, head: Head) -> DataFrame:
    """One pass over the texts that finds two things, told apart by what is null.

    (h, around): of the words that are no units of their own, for each sighting the units before and after it, as 32 bits.
    (pair, n): counts of neighbouring units; there are ``units`` squared at most in a task.
    """
    size = OWN_UNITS + FORM_UNITS
    shared = texts.sparkSession.sparkContext.broadcast(head)

    def task(batches):
        lexicon = Lexicon(shared.value)
        total = np.zeros(size * size, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []  # codes of one numbering, what stands around them
        for _, part in chunks(batches, "text"):
            if held and (lexicon.full() or sum(len(c) for c, _ in held) > HELD):
                yield gathered(lexicon, held)
                held = []
            coded = lexicon.codes([(t or b"").lower().split() for t in part])
            inner = inner_places(coded)
            codes = np.concatenate(coded)
            units = lexicon.units[codes]
            row = np.zeros(len(inner), np.int64)
            row[inner] = units
            total += np.bincount(row[:-1] * size + row[1:], minlength=len(total))
            loose = units >= OWN_UNITS
            at = np.flatnonzero(inner)[loose]
            if len(at):
                held.append((codes[loose], (row[at - 1] << 16 | row[at + 1]).astype(np.uint32)))
        if held:
            yield gathered(lexicon, held)
        at = np.flatnonzero(total)
        yield seen(pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.binary()), pa.array(at), pa.array(total[at]))

    def gathered(lexicon: Lexicon, held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        """A row for each word."""
        codes = np.concatenate([c for c, _ in held])
        order = np.sort((codes << 32) | np.arange(len(codes))) & 0xFFFFFFFF  # by code, then place
        codes, around = codes[order], np.concatenate([a for _, a in held])[order]
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        offsets = (4 * np.append(first, len(codes))).astype(np.int32)
        lists = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(around)])
        none = pa.nulls(len(first), pa.int64())
        return seen(pa.array(lexicon.hashes[codes[first]]), lists, none, none)

    def seen(*columns: pa.Array) -> pa.RecordBatch:
        return pa.record_batch([*columns], ["h", "around", "pair", "n"])

    return texts.mapInArrow(task, "h long, around binary, pair long, n long")


def affinities(table: np.ndarray) -> np.ndarray:
    """What a neighbour says for each class: rows are the class before, then the class after a word. Whole numbers, so
    that sums do not depend on their order.

    The likelihood of class bigrams changes by log(table[b, c]) - log(size of c) when a sighting after b joins class c;
    neighbours at large, PRIOR of them, keep small classes from drawing what they have not seen.
    """
    sizes = table.sum(axis=0)
    at_large = sizes / max(sizes.sum(), 1)
    before = (table + PRIOR * at_large[:, None]) / (sizes + PRIOR)
    after = (table.T + PRIOR * at_large[:, None]) / (sizes + PRIOR)
    return np.rint(1e6 * np.log(np.maximum(np.vstack([before, after]), 1e-12)))


def word_classes(around: DataFrame, member: np.ndarray, table: np.ndarray) -> DataFrame:
    """(h, c, class) of the words: their sightings and the class they fit best, the end's class left out."""
    classes = len(table)
    says = affinities(table)

    def task(batches):
        held: tuple | None = None  # a word may go on in the next batch
        for h, lists, sizes in parts(batches):
            codes = np.frombuffer(b"".join(lists.to_pylist()), np.uint32)
            new = np.concatenate([[True], h[1:] != h[:-1]])
            word = np.repeat(np.cumsum(new) - 1, sizes) * 2 * classes
            h = h[new]
            seen = np.bincount(word + member[codes >> 16], minlength=len(h) * 2 * classes)
            seen += np.bincount(word + classes + member[codes & 0xFFFF], minlength=len(h) * 2 * classes)
            seen = seen.reshape(len(h), 2 * classes)
            if held is not None and held[0][0] == h[0]:
                seen[0] += held[1][0]
            elif held is not None:
                yield judged(*held)
            yield judged(h[:-1], seen[:-1])
            held = h[-1:], seen[-1:]
        if held is not None:
            yield judged(*held)

    def parts(batches):
        """(h, around, sightings) of slices with about ``HELD`` sightings."""
        for batch in batches:
            h, sizes = batch.column(0).to_numpy(), pc.binary_length(batch.column(1)).to_numpy() // 4
            cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // HELD)) + 1
            for a, b in pairwise([0, *cuts.tolist(), len(h)]):
                if b > a:
                    yield h[a:b], batch.column(1).slice(a, b - a), sizes[a:b]

    def judged(h: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
        fit = seen @ says
        fit[:, 0] = -np.inf
        best = fit.argmax(axis=1).astype(np.int32)
        return pa.record_batch([pa.array(h), pa.array(seen[:, :classes].sum(axis=1)), pa.array(best)], ["h", "c", "class"])

    return around.repartition("h").sortWithinPartitions("h").mapInArrow(task, "h long, c long, class int")


@dataclass
class ClassModel:
    head: Head
    member: np.ndarray  # class of each unit
    words: DataFrame  # (h, c, class) of all training words that are no units of their own
    tokens: int
    types: int
    ends: int


def train(texts: DataFrame, counts: DataFrame, classes: int, rounds: int) -> ClassModel:
    totals = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    head = Head.of(counts, HEAD)
    seen = stored(surroundings(texts, head), "lm-around")
    bigrams = summed_pairs(seen.filter("pair is not null").select("pair", "n"), OWN_UNITS + FORM_UNITS)
    member = exchange(bigrams, classes, rounds)
    one = np.zeros((len(bigrams), classes))
    one[np.arange(len(bigrams)), member] = 1
    around = seen.filter("h is not null").select("h", "around")
    words = stored(word_classes(around, member, one.T @ bigrams @ one), "lm-words")
    head.classes = member[np.maximum(head.units, 0)]
    if (head.units < 0).any():
        least = int(head.counts[head.units < 0].min())
        known = words.filter(F.col("c") > least).unionByName(
            words.filter(F.col("c") == least).orderBy("h").limit(int((head.counts == least).sum()))
        )
        known = known.select("h", "class").toArrow()
        at = head.find(known.column("h").to_numpy())
        head.classes[at[at >= 0]] = known.column("class").to_numpy()[at >= 0]
    ends = counts.filter(F.col("h") == END_HASH).first()
    return ClassModel(head, member, words, totals[0] or 0, totals[1], ends["c"] if ends else 0)


def class_paths(rows: DataFrame, model: ClassModel) -> DataFrame:
    """Every row as (id, in_training, n_tokens, n_known, base, emission, path): the class of each token, a byte each, and
    what words add to the scores whatever their class.
    """
    shared = rows.sparkSession.sparkContext.broadcast((model.head, model.member, model.ends))
    base = float(np.log10(model.tokens + model.types + 1))
    fields = ["id", "in_training", "n_tokens", "n_known", "base", "emission", "path", "rare"]
    place = pa.struct([("h", pa.int64()), ("at", pa.int32())])

    def task(batches):
        head, member, ends = shared.value
        lexicon = Lexicon(head)
        for batch, part in chunks(batches, "text"):
            coded = lexicon.codes([(t or b"").lower().split() for t in part])
            class_of = lexicon.classes(member).astype(np.uint8)
            known_base = np.log10(lexicon.counts + 1.0)
            emission = np.log10(np.maximum(lexicon.counts - DISCOUNT, DISCOUNT))  # of a word never seen too
            out: list[tuple] = []
            for codes in coded:
                inside = lexicon.counts[codes] > 0
                total = known_base[codes].sum() + np.log10(ends + 1.0) - base * (len(codes) + 1)
                emitted = emission[codes].sum() + np.log10(max(ends - DISCOUNT, DISCOUNT))
                at = np.flatnonzero(~inside)
                known = len(codes) - len(at) + (ends > 0)
                out.append((len(codes) + 1, known, total, emitted, class_of[codes].tobytes(), lexicon.hashes[codes[at]], at))
            n, known, totals, emitted, paths, hashes, at = zip(*out, strict=True)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum([len(h) for h in hashes])]), pa.int32()),
                pa.StructArray.from_arrays(
                    [pa.array(np.concatenate(hashes), pa.int64()), pa.array(np.concatenate(at), pa.int32())], fields=list(place)
                ),
            )
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                 pa.array(totals, pa.float64()), pa.array(emitted, pa.float64()), pa.array(paths, pa.binary()), lists],
                fields,
            )

    def completed(batches):
        for batch in batches:
            places = batch.column(7)
            paths = []
            for path, found in zip(batch.column(6).to_pylist(), places, strict=True):
                if found.is_valid:
                    classes, found = np.frombuffer(path, np.uint8).copy(), found.values.to_numpy()
                    classes[found >> 8] = found & 255
                    path = classes.tobytes()
                paths.append(path)
            yield pa.record_batch([*batch.columns[:6], pa.array(paths, pa.binary())], fields[:7])

    slim = f"id {rows.schema['id'].dataType.simpleString()}, in_training boolean, n_tokens long, n_known long, base double, emission double, path binary"
    local = stored(rows.mapInArrow(task, f"{slim}, rare array<struct<h:long,at:int>>").withColumn("row", F.monotonically_increasing_id()), "lm-local")
    met = local.select("row", F.explode("rare").alias("r")).select("row", "r.h", "r.at").join(model.words, "h")
    unseen = float(np.log10(DISCOUNT))
    added = met.groupBy("row").agg(
        F.count(F.lit(1)).alias("more_known"),
        F.sum(F.log10(F.col("c") + 1.0)).alias("more_base"),
        F.sum(F.log10(F.greatest(F.col("c") - DISCOUNT, F.lit(DISCOUNT))) - unseen).alias("more_emission"),
        F.collect_list(F.col("at").cast("long") * 256 + F.col("class")).alias("places"),
    )
    zero = F.lit(0)
    whole = local.drop("rare").join(added, "row", "left").select(
        "id",
        "in_training",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", zero)).alias("n_known"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base"),
        (F.col("emission") + F.coalesce("more_emission", zero)).alias("emission"),
        "path",
        "places",
    )
    return whole.mapInArrow(completed, slim)


def class_bigrams(paths: DataFrame, classes: int) -> np.ndarray:
    """Counts of neighbouring classes over all paths; the end's class stands before and after each."""

    def task(batches):
        total = np.zeros(classes * classes, np.int64)
        for batch in batches:
            row = np.frombuffer(b"\0" + b"".join(p + b"\0" for p in batch.column(0).to_pylist()), np.uint8).astype(np.int64)
            total += np.bincount(row[:-1] * classes + row[1:], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], ["pair", "n"])

    return summed_pairs(paths.select("path").mapInArrow(task, "pair long, n long"), classes)


def score_texts(
    df: DataFrame, trains: F.Column, id_col: str = "doc_id", text_col: str = "text", classes: int = 48, rounds: int = 6
) -> DataFrame:
    """Every row as (id, in_training, n_tokens, n_known, train_tokens, base_score, score), scores in log10.

    ``trains`` tells which rows are learned from. ``classes`` may be 2 to 256.
    """
    if not 2 <= classes <= 256:
        raise ValueError("classes must be 2 to 256")
    rows = df.select(
        F.col(id_col).alias("id"), F.coalesce(trains, F.lit(False)).alias("in_training"), F.col(text_col).cast("binary").alias("text")
    )
    texts = rows.filter("in_training").select("text")
    counts = stored(word_counts(texts), "lm-counts")
    model = train(texts, counts, classes, rounds)
    paths = stored(class_paths(rows, model), "lm-paths")
    table = class_bigrams(paths.filter("in_training"), classes)
    transitions = np.log10((table + ADDED) / (table.sum(axis=1, keepdims=True) + ADDED * classes))
    steps = (transitions - np.log10(np.maximum(table.sum(axis=0), 1))).ravel()  # into a class, and one of its sightings

    def task(batches):
        for batch in batches:
            scores = []
            for path, emission in zip(batch.column(6).to_pylist(), batch.column(5).to_pylist(), strict=True):
                row = np.frombuffer(b"\0" + path + b"\0", np.uint8).astype(np.int64)
                scores.append(steps[row[:-1] * classes + row[1:]].sum() + emission)
            yield pa.record_batch([*batch.columns[:5], pa.array(scores, pa.float64())], [*batch.schema.names[:5], "score"])

    kind = df.schema[id_col].dataType.simpleString()
    scored = paths.mapInArrow(task, f"id {kind}, in_training boolean, n_tokens long, n_known long, base double, score double")
    return scored.select(
        "id",
        "in_training",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )
