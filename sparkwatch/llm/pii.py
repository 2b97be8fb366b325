"""Personal data: patterns for direct identifiers, and information-theoretic sanitisation of the terms that reveal them.

Every e-mail address, IP, card or phone number found is a protected entity. Terms within ``window`` words of a mention are
its context. Over the whole corpus, with document counts n,

    disclosure(t, e) = PMI(t; e) / IC(e) = log(n(t, e) * N / (n(t) * n(e))) / log(N / n(e))

is the share of an entity's information that a term gives away: 1 if the term occurs with the entity only, 0 if they are
independent. A term near an entity, be it in one text only, that gives away ``generalise`` or more is replaced by the kind of
term it is, wherever it occurs; from ``remove`` on it is taken out.

Counts are summed before they are shuffled. Which terms to count and to look for is told by a bitmap of fixed size, and
false hits are sorted out by a join on the term itself. Defined results: a null text counts as empty and has no spans;
repeated rows count as documents; of rows with one id or none each has the spans of its own text; further columns are ignored by
the search and kept by ``sanitise``; an empty table gives no rows.
"""

import re
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import chunks, stored

KINDS = ("email", "ip", "card", "phone", "term")
ORDER = {k: i for i, k in enumerate(KINDS)}
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
REACH = 40  # characters per word of a window that are looked through at first
TERM_BITS = 1 << 24  # of the bitmap of terms (2 MB)
BLOCK_BITS = 1 << 15  # in a block of Spark's bitmap functions

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")  # a long run of digits is gone through once
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TERM = re.compile(r"[^\W_]+")

Span = tuple[str, int, int]


def emails(text: str) -> list[Span]:
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append(("email", start, found.end()))
            last = found.end()
        else:
            last = at + 1
        at = text.find("@", max(last, at + 1))
    return out


def ips(text: str) -> list[Span]:
    """Runs of dotted numbers are cut into fours from the left, as a leftmost greedy match does."""
    out = []
    for run in DOTTED.finditer(text):
        parts, start = run.group().split("."), run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append(("ip", start, end))
            start = end + 1
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if i % 2 == 0 else v * 2 - 9 * (v > 4)
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    out = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    return out


def phones(text: str) -> list[Span]:
    if "+" not in text:
        return []
    return [
        ("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= sum(c in "0123456789" for c in m.group()) <= 15
    ]


def base_spans(text: str) -> list[Span]:
    spans = emails(text) + ips(text) + cards(text) + phones(text)
    return sorted(spans, key=lambda s: (s[1], ORDER[s[0]]))


def joined(spans: list[Span]) -> str:
    return ",".join([f"{k}:{a}:{b}" for k, a, b in spans])


def words_before(text: str, end: int, n: int) -> list[tuple[int, int]]:
    """Places of the last n terms before ``end``, however far away they are."""
    reach = REACH * n
    while True:
        low = max(0, end - reach)
        found = [m.span() for m in TERM.finditer(text, low, end)]
        if low and found and found[0][0] == low:  # it may begin farther left
            found = found[1:]
        if len(found) >= n or not low:
            return found[-n:]
        reach *= 4


def words_after(text: str, start: int, n: int) -> list[tuple[int, int]]:
    return [m.span() for m in islice(TERM.finditer(text, start), n)]


def contexts(text: str, spans: list[Span], window: int) -> dict[str, list[str]]:
    """The terms around all mentions of each entity; terms that lie in a span are left away."""
    out: dict[str, set[str]] = {}
    for kind, a, b in spans:
        value = re.sub(r"[ ().-]", "", text[a:b]) if kind in ("card", "phone") else text[a:b].lower()
        near = out.setdefault(f"{kind}:{value}", set())
        for s, e in words_before(text, a, window) + words_after(text, b, window):
            # a piece of a term that a span cuts is no term of the text
            cut = (s == b and TERM.match(text, s - 1, s)) or (e == a and TERM.match(text, a, a + 1))
            if not cut and not any(s < y and e > x for _, x, y in spans):
                near.add(text[s:e].lower())
    return {entity: sorted(terms) for entity, terms in out.items()}


def terms_of(text: str) -> list[str]:
    """The distinct terms of a text in lower case, each lowered by itself as at its places."""
    return list({t.lower() for t in set(TERM.findall(text))})


def text_hash(text: str) -> int:
    """The hash of a text as Spark's xxhash64 has it."""
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def scanned(df: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(id, base spans, text hash and length, mentions) of every row, in one pass; one mention per entity."""
    mention = pa.list_(pa.struct([("entity", pa.string()), ("terms", pa.list_(pa.string()))]))

    def task(batches):
        for batch, texts in chunks(batches, "text"):
            base, hashes, sizes, mentions = [], [], [], []
            for text in texts:
                text = text or ""
                spans = base_spans(text)
                base.append(joined(spans))
                hashes.append(text_hash(text))
                sizes.append(len(text))
                mentions.append([{"entity": e, "terms": t} for e, t in contexts(text, spans, window).items()] if spans else None)
            columns = [batch.column(0), pa.array(base), pa.array(hashes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(mentions, mention)]
            yield pa.record_batch(columns, ["id", "base", "h", "size", "mentions"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        task, f"id {kind}, base string, h long, size int, mentions array<struct<entity:string,terms:array<string>>>"
    )


def bitmap(terms: DataFrame) -> np.ndarray:
    """Bits of the terms' hashes, set in Spark: TERM_BITS bits at most are fetched, in blocks of 4 KB."""
    place = F.pmod(F.xxhash64("term"), F.lit(TERM_BITS)) + 1  # Spark's blocks begin at 1
    slots = terms.select(F.bitmap_bucket_number(place).alias("block"), F.bitmap_bit_position(place).alias("position"))
    blocks = slots.groupBy("block").agg(F.bitmap_construct_agg("position").alias("bits")).toArrow()
    packed = np.zeros((TERM_BITS // BLOCK_BITS, BLOCK_BITS // 8), np.uint8)
    for block, bits in zip(blocks.column(0).to_pylist(), blocks.column(1).to_pylist(), strict=True):
        packed[block - 1] = np.frombuffer(bits, np.uint8)
    return packed.ravel()


def has_bit(packed: np.ndarray, terms: list[str]) -> np.ndarray:
    """Which terms have their bit set; the hash is that of Spark's xxhash64."""
    h = np.fromiter((xxhash.xxh64_intdigest(t.encode(), 42) for t in terms), np.uint64, len(terms))
    slot = (h % np.uint64(TERM_BITS)).astype(np.int64)
    return (packed[slot >> 3] >> (slot & 7)) & 1 == 1


def document_counts(df: DataFrame, text_col: str, packed: np.ndarray) -> DataFrame:
    """(term, n): documents that hold a term whose bit is set, summed per task before the shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(packed)

    def task(batches):
        counts: dict[str, int] = {}
        for _, texts in chunks(batches, "text"):
            for text in texts:
                terms = terms_of(text or "")
                if terms:
                    for i in np.flatnonzero(has_bit(shared.value, terms)).tolist():
                        counts[terms[i]] = counts.get(terms[i], 0) + 1
            if len(counts) > 200_000:
                yield pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["term", "n"])
                counts = {}
        if counts:
            yield pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["term", "n"])

    found = df.select(F.col(text_col).alias("text")).mapInArrow(task, "term string, n long")
    return found.groupBy("term").agg(F.sum("n").alias("n_term"))


def term_spans(df: DataFrame, text_col: str, packed: np.ndarray) -> DataFrame:
    """(h, size, term, start, end) of terms whose bit is set, outside the base spans. Where they lie depends on the text alone."""
    shared = df.sparkSession.sparkContext.broadcast(packed)

    def task(batches):
        for _, texts in chunks(batches, "text"):
            rows: list[tuple] = []
            for text in texts:
                text = text or ""
                terms = terms_of(text)
                if not terms:
                    continue
                hits = {terms[i] for i in np.flatnonzero(has_bit(shared.value, terms)).tolist()}
                if not hits:
                    continue
                base, h = base_spans(text), text_hash(text)
                for m in TERM.finditer(text):
                    term = m.group().lower()
                    if term in hits and not any(m.start() < y and m.end() > x for _, x, y in base):
                        rows.append((h, len(text), term, m.start(), m.end()))
            if rows:
                a, n, b, c, d = zip(*rows, strict=True)
                yield pa.record_batch(
                    [pa.array(a, pa.int64()), pa.array(n, pa.int32()), pa.array(b, pa.string()), pa.array(c, pa.int64()), pa.array(d, pa.int64())],
                    ["h", "size", "term", "start", "end"],
                )

    return df.select(F.col(text_col).alias("text")).mapInArrow(task, "h long, size int, term string, start long, end long")


def revealing_terms(
    df: DataFrame, scan: DataFrame, text_col: str, generalise: float, remove: float
) -> DataFrame | None:
    """(term, disclosure, action) of the terms over the threshold; None where no entity has a term near it."""
    # all counts are of rows; a row has an entity once
    mentions = scan.filter("mentions IS NOT NULL").select(F.explode("mentions").alias("m")).select("m.entity", "m.terms")
    entities = mentions.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    pairs = mentions.select("entity", F.explode("terms").alias("term"))
    together = pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_pair"))
    total = scan.count()

    def disclosure(texts_of_term: str) -> F.Column:
        gain = F.log(F.col("n_pair") * total / (F.col(texts_of_term) * F.col("n_entity")))
        known = F.log(F.lit(float(total)) / F.col("n_entity"))
        return F.when(known > 0, gain / known).otherwise(0.0)

    # a term is in no fewer rows than it is near a mention in: by that, most frequent terms can't reveal anything and aren't counted
    around = scan.filter("mentions IS NOT NULL").select(F.explode(F.array_distinct(F.flatten("mentions.terms"))).alias("term"))
    least = around.groupBy("term").agg(F.count(F.lit(1)).alias("n_least"))
    possible = together.join(entities, "entity").join(least, "term").filter(disclosure("n_least") >= generalise - 1e-9)
    near = stored(possible.drop("n_least"), "pii-pairs")
    if near.isEmpty():
        return None
    counts = document_counts(df, text_col, bitmap(near.select("term")))
    scored = near.join(counts, "term").withColumn("disclosure", disclosure("n_term"))
    best = scored.groupBy("term").agg(F.max("disclosure").alias("disclosure")).filter(F.col("disclosure") >= generalise)
    return stored(
        best.withColumn("action", F.when(F.col("disclosure") >= remove, "remove").otherwise("generalise")), "pii-terms"
    )


def term_hits(df: DataFrame, scan: DataFrame, text_col: str, generalise: float, remove: float) -> DataFrame | None:
    """(h, size, extra) with the spans of revealing terms, for the texts that have any; None where no term reveals anything.

    Texts are known by hash and length, so rows need no ids, and copies of a text are one row.
    """
    terms = revealing_terms(df, scan, text_col, generalise, remove)
    if terms is None or terms.isEmpty():
        return None
    hits = term_spans(df, text_col, bitmap(terms.select("term"))).join(terms, "term")
    return stored(hits.groupBy("h", "size").agg(F.collect_set(F.struct("start", "end", "action")).alias("extra")), "pii-hits")


def find_personal_data(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 6,
    generalise: float = 0.9,
    remove: float = 0.98,
) -> DataFrame:
    """Every row as (id, n_email, n_ip, n_card, n_phone, base_sha256, spans, removed); spans are kind:start:end.

    ``removed`` lists the starts of the term spans that are taken out rather than generalised.
    """
    scan = stored(scanned(df, id_col, text_col, window), "pii-scan")
    hits = term_hits(df, scan, text_col, generalise, remove)
    if hits is None:
        found = scan.withColumn("extra", F.expr("cast(null as array<struct<start:long,end:long,action:string>>)"))
    else:
        found = scan.join(hits, ["h", "size"], "left")
    kinds = F.filter(F.split("base", ","), lambda s: s != "")
    base = F.transform(
        kinds,
        lambda s: F.struct(
            F.split_part(s, F.lit(":"), F.lit(2)).cast("long").alias("start"),
            F.element_at(F.create_map(*[F.lit(x) for k in KINDS for x in (k, ORDER[k])]), F.split_part(s, F.lit(":"), F.lit(1))).alias("rank"),
            s.alias("label"),
        ),
    )
    added = F.transform(
        F.coalesce("extra", F.expr("array()")),
        lambda e: F.struct(
            e["start"].alias("start"),
            F.lit(ORDER["term"]).alias("rank"),
            F.concat_ws(":", F.lit("term"), e["start"].cast("string"), e["end"].cast("string")).alias("label"),
        ),
    )
    ordered = F.array_sort(F.concat(base, added))

    def count(kind: str) -> F.Column:
        return F.size(F.filter(kinds, lambda s: s.startswith(f"{kind}:"))).cast("long").alias(f"n_{kind}")

    return found.select(
        "id",
        *map(count, KINDS[:4]),
        F.sha2("base", 256).alias("base_sha256"),
        F.array_join(F.transform(ordered, lambda s: s["label"]), ",").alias("spans"),
        F.transform(F.filter(F.coalesce("extra", F.expr("array()")), lambda e: e["action"] == "remove"), lambda e: e["start"]).alias("removed"),
    )


def term_label(term: str) -> str:
    return "[NUMBER]" if term.isdigit() else "[NAME]" if term[:1].isupper() else "[TERM]"


def rewritten(text: str, extra: list[dict]) -> str:
    """A text with its spans replaced; of overlapping spans the whole stretch takes the first one's label."""
    spans = [*base_spans(text), *(("term", e["start"], e["end"]) for e in extra)]
    gone = {e["start"] for e in extra if e["action"] == "remove"}
    out, last = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], ORDER[s[0]])):
        if a >= last:
            out.append(text[last:a])
            if kind != "term":
                out.append(LABELS[kind])
            elif a not in gone:
                out.append(term_label(text[a:b]))
        last = max(last, b)
    return "".join([*out, text[last:]])


def all_rewritten(texts: pa.Array, extra: pa.Array | None = None) -> pa.Array:
    """Texts of an Arrow batch rewritten; as Python values they are held in chunks, not all at once."""
    columns = [texts] if extra is None else [texts, extra]
    done = []
    for batch, part in chunks([pa.record_batch(columns, ["text", "extra"][: len(columns)])]):
        more = [None] * len(part) if extra is None else batch.column(1).to_pylist()
        done.append(pa.array([None if t is None else rewritten(t, e or []) for t, e in zip(part, more, strict=True)], pa.string()))
    return pa.concat_arrays(done) if done else pa.array([], pa.string())


def sanitise(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 6,
    generalise: float = 0.9,
    remove: float = 0.98,
) -> DataFrame:
    """``df`` with its spans replaced in the text. Texts are joined with term spans only where there are any."""
    scan = stored(scanned(df, id_col, text_col, window), "pii-scan")
    hits = term_hits(df, scan, text_col, generalise, remove)

    @F.arrow_udf("string")
    def plain(texts: pa.Array) -> pa.Array:
        return all_rewritten(texts)

    @F.arrow_udf("string")
    def both(texts: pa.Array, extra: pa.Array) -> pa.Array:
        return all_rewritten(texts, extra)

    if hits is None:
        return df.withColumn(text_col, plain(text_col))
    whole = F.coalesce(F.col(text_col), F.lit(""))
    known = df.withColumns({"__h": F.xxhash64(whole), "__size": F.char_length(whole)})
    marked = known.join(hits.select(F.col("h").alias("__h"), F.col("size").alias("__size"), F.col("extra").alias("__extra")), ["__h", "__size"], "left")
    return marked.withColumn(text_col, both(text_col, "__extra")).select(df.columns)
