"""The corpus operators against brute force, on tables with nulls, empty, long and repeated texts, and clashing columns."""

from __future__ import annotations

import collections
import functools
import hashlib
import itertools
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from sparkwatch.llm import bpe, brown, common, components, exact, knn, packing, pii, quality, queries, secrets, simhash, substring

SF = "/root/testdata/sf0.001"
WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu", "re", "so", "na", "pe") for b in ("n", "st", "ra", "lim", "o", "wex")]
EXTRA = "doc_id long, text string, id long, h string, n int, score double, label string, spans string, row int, block int"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(queries.TOKENIZER)


def sample_texts() -> list[tuple]:
    """(doc_id, text): prose, copies, near copies, empty, null, blank, long without a space, personal data, a null id."""
    rng = random.Random(5)
    prose = [" ".join(rng.choices(WORDS, k=rng.randint(60, 160))) for _ in range(40)]
    rows = list(enumerate(prose))
    rows += [(100 + i, prose[0]) for i in range(30)]
    for i in range(12):  # near copies: one word of a long text
        words = (prose[1] + " " + prose[2] + " " + prose[3]).split()
        words[i * 5] = "changed"
        rows.append((200 + i, " ".join(words)))
    rows += [(300, ""), (301, None), (302, "   \n\t"), (303, "x" * 60_000), (304, "ab" * 30_000), (305, "one"), (306, "one")]
    rows += [(307, "Mail a.b@c.example.com or +49 (30) 1234567, 10.0.0.1, 4111 1111 1111 1111 <|endoftext|> Ünï 漢字")]
    rows += [(308, "the the " * 5_000), (309, "no  double\n\n lines   here's"), (None, "no id at all"), (305, "one")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 7, "x", None, 0.5, None, "s", 1, 2) for i, t in sample_texts()]
    return spark.createDataFrame(rows, EXTRA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], EXTRA)


# ---- SimHash ----


def plain_fingerprint(text: str | None, shingle: int) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, edges) -> dict:
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash_against_brute_force(docs):
    rows = [(i, t) for i, t in sample_texts() if i is not None and i not in (303, 304, 308)]
    fps = {i: plain_fingerprint(t, 4) for i, t in rows}
    edges = [(a, b) for a, b in itertools.combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 4]
    expected = classes(fps, edges)
    got = simhash.near_duplicates(docs.filter("doc_id NOT IN (303, 304, 308)")).collect()
    assert {(r.id, r.fingerprint, r.component_id) for r in got} == {(i, f"{fps[i]:016x}", expected[i]) for i in fps}
    assert len(got) == len(rows)


def test_simhash_links_on_every_path(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(30)]
    near = [b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 6))) for b in base for _ in range(12)]
    values = sorted(set(base + near + [0, 1, 3, 15, 31, (1 << 64) - 1]))
    fps = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long")
    for bits in (0, 1, 3, 4, 6):
        expected = classes(values, [(a, b) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= bits])
        groups = {frozenset(g) for g in grouped(expected).values() if len(g) > 1}
        for dense in (None, 5) if bits == 4 else (None,):
            roots = components.connected_components(simhash.fingerprint_links(fps, bits, dense)).collect()
            got = {frozenset(g) for g in grouped({r.node % (1 << 64): r.root for r in roots}).values()}
            assert got == groups, (bits, dense)


def grouped(of: dict) -> dict:
    out = collections.defaultdict(set)
    for k, v in of.items():
        out[v].add(k)
    return out


def test_pigeonring_keys_let_no_pair_through_unseen():
    rng = random.Random(1)
    for bits, depth in ((4, 1), (4, 2), (3, 2), (6, 2), (1, 1)):
        masks = [m for _, m in simhash.key_masks(bits, depth)]
        for _ in range(300):
            diff = sum(1 << k for k in rng.sample(range(64), bits))
            assert any(diff & m == 0 for m in masks)


def test_large_runs_are_searched(spark):
    values = [simhash.signed(sum(1 << k for k in c)) for r in range(3) for c in itertools.combinations(range(40, 64), r)]
    links = simhash.links_of_groups(simhash.with_keys(spark.createDataFrame([(v,) for v in values], "fp long"), simhash.key_masks(4, 1)), 4)
    assert links.count() < 20 * len(values)
    roots = components.connected_components(links).select("root").distinct().count()
    assert roots == 1


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 3)]
    roots = components.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()
    of = grouped({r.node: r.root for r in roots})
    assert sorted(len(g) for g in of.values()) == [201, 300]


# ---- packing ----


def test_packing_holds_every_id_once(docs, tokenizer):
    rows = packing.pack_tokens(docs, queries.TOKENIZER).collect()
    expected = collections.Counter()
    for i, t in sample_texts():
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        expected[(i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    # pieces of rows with one id are told apart by their sequence: rebuilt by position where the id is unique
    by_doc = collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    unique = [i for i, n in collections.Counter(i for i, _ in sample_texts()).items() if n == 1]
    texts = dict(sample_texts())
    for i in unique:
        ids = [*tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    windows = collections.defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append(r)
    for pieces in windows.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert sum(r.length for r in rows) == sum(n * k[1] for k, n in expected.items())


def test_differencing_balances():
    rng = random.Random(2)
    for windows in (1, 2, 7, 20):
        sizes = [rng.randint(1, 200) for _ in range(windows * 9)]
        groups = packing.differencing(sizes, windows)
        assert sorted(i for g in groups for i in g) == list(range(len(sizes)))
        sums = [sum(sizes[i] for i in g) for g in groups]
        assert len(groups) == windows and max(sums) - min(sums) <= 60
    assert [sorted(g) for g in packing.balanced([10], 10)] == [[0]]
    assert max(sum([600, 600, 600][i] for i in g) for g in packing.balanced([600, 600, 600], 1024)) <= 1024


def test_packing_pads_little(spark):
    rows = packing.pack_tokens(spark.read.parquet(f"{SF}/documents.parquet"), queries.TOKENIZER).groupBy("sequence_id").sum("length").collect()
    assert 1 - sum(r[1] for r in rows) / (1024 * len(rows)) < 0.03


# ---- exact ----


@pytest.mark.parametrize("hash_bits,capacity", [(64, 100_000), (64, 5), (3, 2), (1, 1)])
def test_exact_duplicates_even_where_hashes_collide(docs, hash_bits, capacity):
    rows = exact.exact_duplicates(docs, hash_bits=hash_bits, capacity=capacity).collect()
    groups = collections.defaultdict(list)
    for i, t in sample_texts():
        groups[t or ""].append(i)
    expected = collections.Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            expected[(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest())] += 1
    assert collections.Counter(tuple(r) for r in rows) == expected


def test_directory_splits_overfull_buckets_only(spark):
    keys = spark.createDataFrame([(i,) for i in range(100)] + [(1 << 19,)], "h long")
    buckets = exact.directory(keys, 20, 20)
    assert sum(1 << (20 - d) for d, _ in buckets) == 1 << 20  # covers all keys, once
    assert max(d for d, _ in buckets) > min(d for d, _ in buckets)


def test_drops_keep_all_columns(docs):
    kept = exact.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({t or "" for _, t in sample_texts()})
    assert simhash.drop_near_duplicates(docs).columns == docs.columns


# ---- BPE ----


def test_bpe_matches_the_library(docs, tokenizer):
    rows = {(r.id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.round_trip(docs, queries.TOKENIZER).collect()}
    expected = set()
    for i, t in sample_texts():
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        expected.add((i, len(ids), sha(",".join(map(str, ids))), sha(decoded)))
    assert rows == expected


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_bpe_ranks_of_two_bytes_are_looked_up(tokenizer, monkeypatch):
    model = bpe.BpeModel(queries.TOKENIZER)
    searched = []
    ranks_of = model.pair_ranks
    monkeypatch.setattr(model, "pair_ranks", lambda a, b: searched.append(len(a)) or ranks_of(a, b))
    words = [bytes([a, b]) for a in range(256) for b in range(256)]
    whole = [i[0] if len(i := np.frombuffer(w, "<u4")) == 1 else tuple(i) for w in model.encode_words(words)]
    assert sum(searched) == 0  # nothing is left to merge after two bytes
    for a in range(0, 256, 5):
        left, right = np.repeat(model.byte_ids[a], 256), model.byte_ids
        ranks = ranks_of(left, right).tolist()
        expected = [model.made[r] if r != bpe.NONE else (x, y) for r, x, y in zip(ranks, left, right, strict=True)]
        assert whole[256 * a : 256 * (a + 1)] == expected


def test_bpe_on_random_texts(spark, tokenizer):
    from sparkwatch.llm.bpe import decode_ids, encode_ids, text_encoder

    rng = random.Random(4)
    alphabet = " \n\t'ab1,.é漢  ́😀ſ՘\U00010940\x1c<|>st"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(1500)]
    texts += ["a<|endoftext|>b  <|endoftext|>", "<|endoftext|>", "aaaaaaa" * 300, "we've  it's\n\n 'll", " x", "x "]
    encoder = text_encoder(queries.TOKENIZER)
    for text, parts in zip(texts, encoder.encode(texts), strict=True):
        assert "".join(p[1] for p in parts)[1:] == ",".join(map(str, tokenizer.encode(text, add_special_tokens=False).ids)), text
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:200])], "doc_id long, text string")
    back = decode_ids(encode_ids(df, queries.TOKENIZER), queries.TOKENIZER)
    assert {(r.id, r.text) for r in back.collect()} == {(i, t) for i, t in enumerate(texts[:200])}


def test_ids_are_gathered_at_once(tokenizer, monkeypatch):
    """No piece is encoded by itself, what a full cache drops is learned again, and ids stay those of the library."""

    def never(self, words):
        raise AssertionError("pieces are encoded from one array")

    monkeypatch.setattr(bpe.BpeModel, "encode_words", never)
    rng = random.Random(6)
    alphabet = " \n\t'ab1,.é漢  ́😀ſ՘\U00010940\x1c<|>st"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(600)]
    texts += [" ".join(rng.choices([*WORDS, "don't", "x-1", "a\tb"], k=40)) for _ in range(100)]
    texts += ["a<|endoftext|>b  <|endoftext|>", "<|endoftext|>", "<|endoftext|><|endoftext|> ", " x", "x ", " ", ""] * 3
    rng.shuffle(texts)
    encoder = bpe.IdEncoder(bpe.model_of(queries.TOKENIZER), 150)
    for i in range(0, len(texts), 40):
        for text, ids in zip(texts[i : i + 40], encoder.encode(texts[i : i + 40]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    assert [*encoder.encode([])] == [] and [*encoder.encode([""])] == [b""]


# ---- quality ----


def test_quality_held_out_accuracy(spark):
    scored = queries.QUERIES["op7_nb_svm_quality"](spark, SF.replace("0.001", "0.01")).toPandas()
    labels = spark.read.parquet(SF.replace("0.001", "0.01") + "/labels.parquet").toPandas().merge(scored, on="doc_id")
    held = labels[labels.held_out]
    assert ((held.predicted == held.quality).mean()) > 0.9
    assert scored.score.between(0, 1).all() and scored.score.notna().all()
    assert (scored.held_out == scored.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()


def test_quality_without_labels_and_odd_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.score_quality(docs, none, score_col="__s").collect()
    assert len(rows) == docs.count() and all(r["__s"] == 0.5 for r in rows)
    some = spark.createDataFrame([(i, int(i < 20)) for i in range(40)] + [(1, None), (None, 1), (1, 0)], "doc_id long, quality int")
    assert all(0 <= r["__s"] <= 1 for r in quality.score_quality(docs, some, score_col="__s").collect())


def test_coordinate_descent_separates():
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(50, 8, replace=False)) + 50 * (k % 2) for k in range(200)]
    y = np.where(np.arange(200) % 2 == 0, 1.0, -1.0)
    w, b = quality.coordinate_descent(rows, [np.ones(8) / np.sqrt(8)] * 200, y, 100, 1.0, 50)
    assert all(np.sign(w[r].sum() / np.sqrt(8) + b) == t for r, t in zip(rows, y, strict=True))


def test_sanitising_holds_a_batch_in_chunks():
    texts = pa.array([f"write to u{i}@example.org " + "x y " * 25_000 for i in range(120)] + [None, ""])
    extra = pa.array([[{"start": 0, "end": 5, "action": "remove"}]] + [None] * 121)
    tracemalloc.start()
    out = pii.all_rewritten(texts, extra)
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held < 8_000_000 < texts.nbytes
    assert out.to_pylist() == [None if t is None else pii.rewritten(t, e or []) for t, e in zip(texts.to_pylist(), extra.to_pylist())]
    assert pii.all_rewritten(texts[:0]).to_pylist() == [] and pii.all_rewritten(texts[:1])[0].as_py().startswith("write to [EMAIL] x")


# ---- language model ----


def test_quality_scores_a_batch_in_chunks(spark, monkeypatch):
    model = quality.Model(np.ones(1 << quality.BITS), np.ones(1 << quality.BITS), 0.0, 1.0, 0.0)
    texts = [f"row {i} holds three words" for i in range(50)] + [None, ""]
    held = []
    part_of = quality.chunks
    monkeypatch.setattr(quality, "chunks", lambda batches: (held.append(len(t)) or (b, t) for b, t in part_of(batches)))
    monkeypatch.setattr(common, "CHUNK_CHARS", 200)
    (scores,) = quality.quality_column(model, spark).func(iter([pa.array(texts)]))
    assert sum(held) == len(texts) and max(held) < 10
    assert scores.to_pylist() == [model.score(quality.Features().of(t or "")) for t in texts]


def test_chunks_give_freed_memory_back():
    if not hasattr(common.ctypes.CDLL(None), "malloc_trim"):
        pytest.skip("the C library has no malloc_trim")

    def resident() -> int:
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4096

    values = [bytes(2_000) for _ in range(50_000)]
    kept = values[-1]  # keeps the heap from shrinking at its end
    del values
    before = resident()
    assert len(list(common.chunks([pa.record_batch([pa.array(["a", None])], ["text"])]))) == 1
    assert before - resident() > 50_000_000 and len(kept) == 2_000


def test_lm_base_and_counts(spark, docs):
    trains = brown.F.col("doc_id") % 3 != 0
    rows = brown.score_texts(docs, trains).collect()
    counts = collections.Counter()
    for i, t in sample_texts():
        if i is not None and i % 3:
            counts.update([*words_of(t), "\n"])
    n, v = sum(counts.values()), len(counts)
    texts = collections.defaultdict(list)
    for i, t in sample_texts():
        texts[i].append(t)
    assert len(rows) == len(sample_texts())
    for r in rows:
        tokens = [*words_of(texts[r.id][0]), "\n"]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens))
        assert r.score < 0


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def test_lm_words_are_numbered_in_one_look_up(monkeypatch):
    head = brown.Head(np.array([brown.word_hash(b"the")]), np.array([9]), np.array([1]))
    words = [b"the", b"cat", b"\xff" * 20, b"the", b"sat", b"", b"a" * 13, b"b" * 9 + b"aaa"]
    hashed = []
    form = brown.form
    monkeypatch.setattr(brown, "form", lambda w: hashed.append(w) or form(w))
    lexicon = brown.Lexicon(head)
    first, second = lexicon.codes([words, [b"new", b"cat"]])
    assert first.tolist() == [0, 1, 2, 0, 3, 4, 5, 6] and second.tolist() == [7, 1]
    distinct = list(dict.fromkeys([*words, b"new"]))
    assert lexicon.hashes.tolist() == [brown.word_hash(w) for w in distinct]
    assert lexicon.units.tolist() == [1, *(brown.OWN_UNITS + form(w) for w in distinct[1:])]
    assert len(hashed) == 6  # one ending of one length is hashed once


def test_lm_bigrams_and_neighbours_come_from_one_pass(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(rng.choices(WORDS, k=rng.randint(1, 30))) for _ in range(60)] + ["", None, "LONE"]
    words = [(t or "").lower().split() for t in texts]
    counts = collections.Counter(w for ws in words for w in ws)
    own = {w: 1 + i for i, (w, _) in enumerate(counts.most_common(5))}
    hashes = {brown.word_hash(w.encode()): u for w, u in own.items()} | {brown.END_HASH: 0}
    head = brown.Head(*(np.array(c, np.int64) for c in zip(*[(h, 9, u) for h, u in sorted(hashes.items())], strict=True)))
    unit = {w: own.get(w, brown.OWN_UNITS + brown.form(w.encode())) for w in counts}
    pairs, around = collections.Counter(), collections.defaultdict(list)
    for ws in words:
        row = [0, *[unit[w] for w in ws], 0]
        pairs.update(itertools.pairwise(row))
        for i, w in enumerate(ws):
            if w not in own:
                around[brown.word_hash(w.encode())].append((row[i], row[i + 2]))
    monkeypatch.setattr(brown, "HELD", 50)
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(brown.F.col("text").cast("binary").alias("text"))
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, "7")
    try:
        rows = brown.surroundings(df.coalesce(1), head).collect()
    finally:
        spark.conf.set(batch, before)
    size = brown.OWN_UNITS + brown.FORM_UNITS
    found = collections.defaultdict(list)
    for r in rows:
        if r.h is not None:
            found[r.h] += [(int(c) >> 16, int(c) & 0xFFFF) for c in np.frombuffer(bytes(r.around), np.uint32)]
    assert {divmod(r.pair, size): r.n for r in rows if r.pair is not None} == pairs
    assert {h: sorted(c) for h, c in found.items()} == {h: sorted(c) for h, c in around.items()}


def test_lm_head_and_tail_agree(docs, monkeypatch):
    trains = brown.F.col("doc_id") % 3 != 0
    wide = {(r.id, r.n_tokens): r for r in brown.score_texts(docs, trains).collect()}
    monkeypatch.setattr(brown, "HEAD", 6)
    for r in brown.score_texts(docs, trains).collect():
        assert r.base_score == pytest.approx(wide[(r.id, r.n_tokens)].base_score)
        assert r.n_known == wide[(r.id, r.n_tokens)].n_known


def test_lm_beats_the_base_on_held_out_texts(spark):
    rows = queries.QUERIES["op8_brown_class_lm"](spark, SF.replace("0.001", "0.01")).toPandas()
    held = rows[rows.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_lm_rare_words_of_one_form_are_classed_by_their_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(7)
    groups = [[f"{g}{i:03d}x" for i in range(400)] for g in "ab"]
    texts = [" ".join(w) for g in groups for w in np.array([rng.permutation(g) for _ in range(30)]).reshape(-1, 10)]
    rare = ["qaxing", "qbxing"]  # one length, one ending: they share a unit, and both are too rare for one of their own
    assert brown.form(rare[0].encode()) == brown.form(rare[1].encode()) and 800 > brown.OWN_UNITS
    around = [" ".join([*rng.choice(g, 4), "{}", *rng.choice(g, 4)]) for g in groups for _ in range(8)]
    texts += [t.format(rare[i // 8]) for i, t in enumerate(around)]
    asked = [t.format(rare[(i // 8 + swap) % 2]) for swap in (0, 1) for i, t in enumerate(around)] + ["never seen", None, ""]
    rows = [(i, t) for i, t in enumerate(texts)] + [(10**6 + i, t) for i, t in enumerate(asked)]
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def scores() -> dict[int, float]:
        return {r.id: r.score for r in brown.score_texts(df, brown.F.col("doc_id") < 10**6, classes=6).collect()}

    wide = scores()
    assert sum(wide[10**6 + i] for i in range(16)) > sum(wide[10**6 + i] for i in range(16, 32)) + 1
    monkeypatch.setattr(brown, "HEAD", 801)  # the rare words are joined now
    narrow = scores()
    assert len(narrow) == len(wide) == len(rows) and all(narrow[i] == pytest.approx(wide[i]) for i in wide)


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(3)
    group = np.arange(40) % 4
    bigrams = rng.poisson(np.where((group[:, None] + 1) % 4 == group[None, :], 30, 0.3)).astype(np.int64)
    bigrams[0], bigrams[:, 0] = 0, 0
    member = brown.exchange(bigrams, 6, 20)

    def likelihood(of):
        one = np.zeros((40, 6))
        one[np.arange(40), of] = 1
        table = one.T @ bigrams @ one
        return brown.gain(table).sum() - brown.gain(table.sum(0)).sum() - brown.gain(table.sum(1)).sum()

    start = np.concatenate([[0], 1 + np.arange(39) % 5])
    assert member[0] == 0 and likelihood(member) > likelihood(start)


# ---- top-k ----


@pytest.mark.parametrize("pivots,block", [(256, 4096), (7, 16), (1, 5)])
def test_top_k_against_brute_force(spark, pivots, block):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.normal(size=8)], "v") for i in range(400)]
    rows += [(400 + i, rows[5][1], "v") for i in range(15)]  # ties
    rows += [(500, None, "v"), (501, [1.0, None], "v"), (502, [float("nan")] * 8, "v"), (503, [float("inf")], "v")]
    rows += [(600, [], "v"), (700, [0.5, -0.5], "v"), (800, [1e-9] * 8, "v"), (None, [1.0] * 8, "v")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string")
    got = knn.top_k(df, knn.F.col("vec_id") % 100 == 0, pivots=pivots, block=block).collect()
    ok = {i: np.floor(1024 * np.array(([*e, *[0.0] * 8])[:8])).astype(int) for i, e, _ in rows if i is not None and i not in range(500, 504)}
    expected = set()
    for q in (i for i in ok if i % 100 == 0):
        best = sorted(((-int(ok[q] @ x), i) for i, x in ok.items() if i != q))[:10]
        expected |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == expected and len(got) == len(expected)


def test_top_k_with_a_cell_that_many_queries_need(spark, monkeypatch):
    """All products negative and large, so bounds are; queries of a block come in parts of two."""
    rng = np.random.default_rng(3)
    rows = [(i, (-(2.0**20) * sign * rng.uniform(0.5, 1, 4)).tolist()) for i, sign in enumerate([1] * 90)]
    rows += [(100 * i + 1_000, (2.0**20 * rng.uniform(0.5, 1, 4)).tolist()) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: np.floor(1024 * np.array(e)).astype(int) for i, e in rows}
    queries_ = [i for i in whole if i % 100 == 0]
    expected = set()
    for q in queries_:
        best = sorted((-int(whole[q] @ x), i) for i, x in whole.items() if i != q)[:10]
        expected |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    monkeypatch.setattr(knn, "QUERIES", 2)
    got = knn.top_k(df, knn.F.col("vec_id") % 100 == 0, pivots=5, block=16).collect()
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == expected and len(got) == len(expected)


# ---- personal data ----


def test_base_spans_against_the_patterns():
    rng = random.Random(6)
    alphabet = "ab1.2@-+ ()9,%_"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(4000)]
    texts += ["a@b.c@d.e", "1.2.3.4.5.6.7.8", "999.1.1.1", "4111 1111-1111 1111", "+49 170 1234567", "1" * 5000, "a" * 5000, "@@@", "00000000001.2.3.4"]
    for text in texts:
        expected = []
        for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
            expected.append(("email", *m.span()))
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
            if all(int(p) <= 255 for p in m.group().split(".")):
                expected.append(("ip", *m.span()))
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            digits = re.sub("[^0-9]", "", m.group())
            if 12 <= len(digits) <= 19:
                odd = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
                if odd % 10 == 0:
                    expected.append(("card", *m.span()))
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
            if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
                expected.append(("phone", *m.span()))
        expected.sort(key=lambda s: (s[1], pii.ORDER[s[0]]))
        assert pii.base_spans(text) == expected, text


def test_revealing_terms_are_found_and_replaced(spark):
    plain = [(i, f"{WORDS[i % 40]} {WORDS[(i * 7) % 48]} talk of things number{i}", "z") for i in range(200)]
    told = [(300 + i, f"{WORDS[i]} the Zorblax office writes from zed@corp.example.org about {WORDS[i + 5]}", "z") for i in range(6)]
    clean = [(400, "a Zorblax was seen and nothing else", "z"), (401, None, "z"), (402, "", "z"), (None, "zorblax zorblax", "z")]
    df = spark.createDataFrame(plain + told + clean, "doc_id long, text string, extra string")
    rows = {r.id: r for r in pii.find_personal_data(df).collect()}
    assert len(rows) == df.count()
    assert "term:2:9" in rows[400].spans and "term:" not in rows[0].spans and rows[401].spans == ""
    assert rows[300].n_email == 1 and "email:" in rows[300].spans
    assert rows[300].base_sha256 == sha(",".join(s for s in rows[300].spans.split(",") if not s.startswith("term")))
    out = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert "Zorblax" not in out[400] and "zed@corp" not in out[300] and "[EMAIL]" in out[300]
    assert out[0] == plain[0][1] and out[401] is None
    assert pii.sanitise(df).columns == df.columns


def test_rare_entities_are_judged_too(spark):
    plain = [(i, f"{WORDS[i % 40]} {WORDS[(i * 7) % 48]} talk of things") for i in range(300)]
    told = [(400, "we met Quillon at quil@corp.example.org and talk of things"), (401, "Vexmar calls +49 30 1234567 to talk"), (402, "Vexmar calls +49 30 1234567 to talk of things")]
    df = spark.createDataFrame([*plain, *told], "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert "Quillon" not in out[400] and "Vexmar" not in out[401] and "Vexmar" not in out[402]  # in one text, in two
    assert "talk of things" in out[400] and all(out[i] == text for i, text in plain)


def test_sanitise_without_terms(docs):
    out = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "[EMAIL]" in out[307] and "[PHONE]" in out[307] and "[CARD]" in out[307] and "[IP]" in out[307]
    assert out[0] == dict(sample_texts())[0]


def spans_by_pmi(texts, window=6, generalise=0.9):
    """Term spans by counting rows one by one; the base spans are those of the patterns."""
    texts = [t or "" for t in texts]
    near, with_entity, with_term = collections.Counter(), collections.Counter(), collections.Counter()
    base = [pii.base_spans(t) for t in texts]

    def free(start, end, spans):
        return not any(start < b and end > a for _, a, b in spans)

    words = [[(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"[^\W_]+", t)] for t in texts]
    for text, spans, tokens in zip(texts, base, words):
        found: dict = {}
        for kind, a, b in spans:
            value = re.sub(r"[ ().-]", "", text[a:b]) if kind in ("card", "phone") else text[a:b].lower()
            left = [t for t in tokens if t[0] < a]
            left = [(s, min(e, a), text[s : min(e, a)].lower()) for s, e, _ in left][-window:]
            right = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"[^\W_]+", text[b:])][:window]
            right = [(s + b, e + b, w) for s, e, w in right]
            found.setdefault((kind, value), set()).update(w for s, e, w in left + right if (s, e) in {t[:2] for t in tokens} and free(s, e, spans))
        for entity, terms in found.items():
            with_entity[entity] += 1
            near.update((entity, t) for t in terms)
        with_term.update({t[2] for t in tokens})
    n = len(texts)
    best: dict = {}
    for (entity, term), both in near.items():
        known = math.log(n / with_entity[entity])
        gain = math.log(both * n / (with_term[term] * with_entity[entity])) / known if known > 0 and with_term[term] else 0
        best[term] = max(best.get(term, 0), gain)
    return [sorted((s, e) for s, e, w in tokens if best.get(w, 0) >= generalise and free(s, e, spans)) for tokens, spans in zip(words, base)]


def test_term_spans_against_counting(spark):
    """Equal ids with other texts, rows without an id, terms far from their mention, copies, and letters that change length in lower case."""
    rng = random.Random(12)
    gap = " " * 900
    texts = [" ".join(rng.choices(WORDS, k=30)) for _ in range(25)]
    texts += [f"Quillonette writes from {i}@mail.example.org to {rng.choice(WORDS)}" for i in range(3)]
    texts += [f"a@b.co {gap}Quillonettes{gap} Zebrafish", f"{'y' * 700}Marker {gap} +49 30 1234567", "Quillon at the gate", "quillonette alone", "zebrafish marker"]
    texts += ["İstanbul office 10.1.2.3 Kelvinism", "istanbul kelvinism İSTANBUL", None, "", "a@b.co", *["Copied text by copyist 10.9.9.9"] * 6, "copyist", "c@d.comé attached", "é alone", "e@f.org" + "é" * 3, "ééé é"]
    ids = [i % 9 if i % 5 else None for i in range(len(texts))]
    frame = spark.createDataFrame(list(zip(ids, texts, range(len(texts)))), "doc_id long, text string, n int")
    expected = collections.Counter()
    for i, text, terms in zip(ids, texts, spans_by_pmi(texts)):
        every = [*pii.base_spans(text or ""), *(("term", a, b) for a, b in terms)]
        expected[i, pii.joined(sorted(every, key=lambda s: (s[1], pii.ORDER[s[0]])))] += 1
    got = collections.Counter((r["id"], r["spans"]) for r in pii.find_personal_data(frame).collect())
    assert got == expected and sum("term:" in s for _, s in got) >= 8
    cleaned = {r["n"]: r["text"] for r in pii.sanitise(frame).collect()}
    assert len(cleaned) == len(texts) and cleaned[texts.index("Quillon at the gate")] == "Quillon at the gate"
    assert "10.9.9.9" not in "".join(t or "" for t in cleaned.values())


# ---- passages ----


def test_compact_windows_are_subtree_spans():
    rng = np.random.default_rng(5)
    for _ in range(30):
        sizes = rng.integers(0, 60, 4)
        values = rng.permutation(int(sizes.sum())).astype(np.uint64) + np.uint64(1)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        got = set(zip(*(x.tolist() for x in substring.compact_windows(values, bounds, 6)), strict=True))
        expected = set()
        for a, b in zip(bounds, bounds[1:], strict=False):
            for c in range(a, b):
                low, high = c, c
                while low > a and values[low - 1] > values[c]:
                    low -= 1
                while high < b - 1 and values[high + 1] > values[c]:
                    high += 1
                if high - low + 1 >= 6:
                    expected.add((low, c, high))
        assert got == expected


def test_shared_passages_are_linked(spark):
    rng = random.Random(9)

    def prose(n):
        return [f"w{rng.randint(0, 9999)}" for _ in range(n)]

    passage, other = prose(60), prose(80)
    rows = [(i, " ".join(prose(rng.randint(0, 200)) + passage + prose(rng.randint(0, 200)))) for i in range(10)]
    edited = list(other)
    edited[40] = "edited"
    rows += [(20, " ".join(prose(90) + other)), (21, " ".join(edited + prose(50)))]
    rows += [(30 + i, " ".join(prose(150))) for i in range(10)] + [(50, None), (51, ""), (52, "short text"), (None, " ".join(passage))]
    df = spark.createDataFrame([(i, t, "a") for i, t in rows], "doc_id long, text string, a string")
    found = substring.repeated_passages(df).collect()
    of = {r.id: r.class_id for r in found} | {r.other_id: r.class_id for r in found}
    assert of == {**{i: 0 for i in range(10)}, 20: 20, 21: 20}
    for r in found:
        assert r.similarity >= 0.8 and min(r.n_words, r.other_n_words) >= 50


def test_windows_after_the_first_of_a_value_count(spark):
    rng = random.Random(12)

    def prose(n):
        return [f"w{rng.randint(0, 99_999)}" for _ in range(n)]

    rows = []
    for i in range(60):  # lines on their own before they make up a passage
        one, two = prose(30), prose(30)
        rows.append((2 * i, " ".join(prose(40) + two + prose(40) + one + prose(40) + two + prose(40) + one + prose(40) + one + two + prose(40))))
        rows.append((2 * i + 1, " ".join(prose(40) + one + two + prose(40))))
    twice = prose(60)
    rows += [(500, " ".join(prose(70) + twice)), (501, " ".join(twice + prose(90) + twice))]
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.other_id, r.id) for r in found} == {(2 * i, 2 * i + 1) for i in range(60)} | {(500, 501)}
    assert {r.start_word // 50 for r in found if r.id == 501} == {0, 3} or len({r.start_word for r in found if r.id == 501}) == 2


def test_windows_meet_whatever_the_batches(spark):
    rng = random.Random(31)
    rows = set()
    for v, most in enumerate([1, 2, 5, 12, 13, 14, 40, 200, 3, 1]):
        rows |= {(v * 8 + rng.randint(0, 5), rng.randint(0, most // 2), (c := rng.randint(100, 900)), ((c - rng.randint(0, 50)) << 32) | (c + rng.randint(45, 90))) for _ in range(most)}
    expected = collections.Counter()
    places = set()
    for v in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == v), key=lambda r: r[:3])
        pairs = [(x, y) for i, x in enumerate(group) for y in group[i + 1 :]]
        if len(group) > substring.ALL_PAIRS:
            for _, i, c, ends in group:
                low, high = max(ends >> 32, c - 45), min(c, (ends & 0xFFFFFFFF) - 45)
                places |= {(i, v & 7, p) for p in range(low, high + 1)}
            pairs, before = [], None
            for x, y in itertools.pairwise(group):
                before = x if x[1] != y[1] else before
                pairs += [(group[0], y)] + [(before, y)] * bool(before and before[1] != group[0][1])
        expected.update((x[1], y[1], v & 7, *x[2:], *y[2:]) for x, y in pairs if x[1] != y[1])
    df = spark.createDataFrame(sorted(rows), "v long, id long, c long, lr long")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(key)
    for size in ("1", "7", "10000"):
        spark.conf.set(key, size)
        try:
            found = substring.links(df, 46).collect()
        finally:
            spark.conf.set(key, usual)
        assert collections.Counter(tuple(r) for r in found if r.f < substring.CROWDED) == expected
        told = [r for r in found if r.f >= substring.CROWDED]
        assert {(r.a, r.f - substring.CROWDED, p) for r in told for p in range(r.ca, r.lra + 1)} == places


def test_shingles_of_texts_together_are_those_of_each():
    rng = random.Random(33)
    letters = [b"a", b"B", b"z9", b"\xc3\xa9", b"\x85", b"\x1c", bytes(1)]
    words = [b"".join(rng.choices(letters, k=rng.choice([1, 2, 3, 5, 8, 13, 40]))) for _ in range(60)]
    texts = [None, b"", b"one two", *(rng.choice([b" ", b"\t\n", b"\x0b\r "]).join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(40)), b" "]
    flat, bounds = substring.Shingler(3).of(texts)
    for i, text in enumerate(texts):
        hashes = [xxhash.xxh64_intdigest(w, 5) for w in (text or b"").lower().split()]
        expected = np.array([functools.reduce(lambda x, h: (x * int(substring.ODD) + h) % (1 << 64), hashes[p : p + 3], 0) for p in range(len(hashes) - 2)], np.uint64)
        assert flat[bounds[i] : bounds[i + 1]].tolist() == substring.mixed(expected, 99).tolist()


def test_windows_of_repeating_texts_travel_as_runs(spark):
    """A text that repeats itself has a window at every place, and each would be a row of its own."""
    rng = random.Random(34)

    def prose(n):
        return [f"w{rng.randint(0, 99_999)}" for _ in range(n)]

    line, block = prose(20), prose(70)
    bodies = [["la"] * 3000, prose(90) + ["la"] * 900 + prose(90), line * 60, prose(60) + line * 30, block * 12, prose(30) + block * 14, prose(300)]
    rows = [(i, " ".join(body).encode()) for i, body in enumerate(bodies)]
    least = 46
    runs = substring.window_table(spark.createDataFrame(rows, "id long, text binary"), 5, 6, least).cache()
    flat, bounds = substring.Shingler(5).of([text for _, text in rows])
    expected = collections.Counter()
    for f in range(6):
        values = substring.mixed(flat, f) >> np.uint64(3)
        for low, c, high in zip(*(x.tolist() for x in substring.compact_windows(values, bounds, least)), strict=True):
            i = int(np.searchsorted(bounds, c, "right")) - 1
            v = int(((values[c] << np.uint64(3)) | np.uint64(f)).view(np.int64))
            expected[v, i, c - int(bounds[i]), ((low - int(bounds[i])) << 32) | (high - int(bounds[i]))] += 1

    def single(found, first, ends, lengths):
        """Rows of runs, each as the rows of its windows; first and ends: the columns that go on."""
        out = collections.Counter()
        for r in found:
            at, c, low, high = (x.tolist() for x in substring.run_rows(np.array([r.run])))
            for step, x, y in zip(c, low, high, strict=True):
                row = list(r)[:lengths]
                row[first], row[ends] = row[first] + step, row[ends] + (x << 32) + y
                out[tuple(row)] += 1
        return out

    found = runs.collect()
    assert single(found, 2, 3, 4) == expected
    assert len(found) < sum(expected.values()) / 4
    plain = substring.links(spark.createDataFrame(list(expected.elements()), "v long, id long, c long, lr long"), least).collect()
    linked = substring.links(runs, least).collect()
    crowded = substring.CROWDED
    assert single([r for r in linked if r.f < crowded], 5, 6, 7) == collections.Counter(tuple(r) for r in plain if r.f < crowded)
    assert len(linked) < len(plain) / 4
    ranges = [
        {(r.id, p) for r in substring.crowded_stretches(spark.createDataFrame(x, s).filter(f"f >= {crowded}"), 1).collect() for y in r.ranges for p in range(y.s, y.e + 1)}
        for x, s in ((plain, "a long, b long, f long, ca long, lra long, cb long, lrb long"), (linked, "a long, b long, f long, ca long, lra long, cb long, lrb long, run long"))
    ]
    assert ranges[0] == ranges[1] and ranges[0]


def test_stretches_that_enough_functions_crowd(spark):
    rng = random.Random(32)
    rows = [(i, 8 + f, s, s + rng.randint(0, 30)) for i in range(9) for f in range(6) for s in range(rng.randint(0, 40), 400, 60)]
    df = spark.createDataFrame(rows, "a long, f long, ca long, lra long")
    depth = collections.Counter((i, p) for i, _, s, e in rows for p in range(s, e + 1))
    found = {(r.id, p) for r in substring.crowded_stretches(df, 4).collect() for x in r.ranges for p in range(x.s, x.e + 1)}
    assert found == {at for at, n in depth.items() if n >= 4}


def shared_lines(rng: random.Random) -> tuple[list[tuple], list[tuple]]:
    """(rows, pairs): passages of two documents whose lines also occur by themselves in many others."""
    words = itertools.count()

    def prose(n):
        return [f"w{next(words)}x{rng.randint(0, 99)}" for _ in range(n)]

    rows, pairs = [], []
    for k in range(12):
        one, two = prose(30), prose(30)
        base = 1000 * k
        for i in range(20):
            at = base + i + 60 * (i % 2)  # before both documents of the passage, or between them
            rows.append((at, " ".join(prose(50) + one + prose(50))))
            rows.append((at + 25, " ".join(prose(50) + two + prose(50))))
        a, b = base + 50, base + 150
        rows += [(a, " ".join(prose(50) + one + two + prose(50))), (b, " ".join(prose(30) + one + two + prose(70)))]
        pairs.append((a, b))
    return rows, pairs


def test_lines_shared_by_many_do_not_part_a_passage(spark):
    rows, pairs = shared_lines(random.Random(21))
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # brute force: documents with a common stretch of 50 words
    by_stretch = collections.defaultdict(set)
    for i, text in rows:
        words = text.split()
        for p in range(len(words) - 49):
            by_stretch[tuple(words[p : p + 50])].add(i)
    assert {tuple(sorted(x)) for x in by_stretch.values() if len(x) > 1} == set(pairs)
    assert {(r.other_id, r.id) for r in found} == set(pairs)
    assert all(r.n_words >= 60 for r in found)


def test_similar_passages_on_crowded_values(spark):
    """A passage and its variant, without 50 words in common at a stretch, whose pieces many others hold in between."""
    rng, words = random.Random(23), itertools.count()

    def prose(n):
        return [f"w{next(words)}x{rng.randint(0, 99)}" for _ in range(n)]

    rows, pairs = [], set()
    for k in range(8):
        passage = prose(72)
        variant = [*passage[:36], *prose(1), *passage[37:]]
        pieces = [passage[i : i + 14] for i in range(0, 64, 9)]
        base = 1000 * k
        for at in [*range(20), *range(100, 120), *range(200, 220)]:
            rows.append((base + at, " ".join(prose(30) + [w for p in pieces for w in [*p, *prose(42)]])))
        a, b = base + 50, base + 150
        rows += [(a, " ".join(prose(60) + passage + prose(60))), (b, " ".join(prose(50) + variant + prose(70)))]
        pairs.add((a, b))
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.other_id, r.id) for r in found} == pairs
    assert all(r.similarity >= 0.8 and r.n_words >= 50 for r in found)
    assert {(r.id, r.class_id) for r in found} == {(b, a) for a, b in pairs}


# ---- secrets ----


def test_secret_scan(spark):
    rng = random.Random(8)
    hexes = ["".join(rng.choices("0123456789abcdef", k=40)) for _ in range(60)]
    rows = [(i, f'{WORDS[i % 40]} token = "{h}" {WORDS[(i + 3) % 40]}') for i, h in enumerate(hexes[:30])]
    rows += [(100 + i, f"commit {h} by {WORDS[i % 40]}") for i, h in enumerate(hexes[30:])]
    rows += [(200 + i, f"card {rng.randint(10**15, 10**16 - 1)} or kanstkanstkanstral{i}") for i in range(30)]
    rows += [(300, None), (301, ""), (302, "AKIA" + "Q7" * 8), (None, "token = \"" + hexes[0] + '"')]
    df = spark.createDataFrame([(i, t, 1.0, "k") for i, t in rows], "doc_id long, text string, label double, candidate string")
    found = {(r.id, r.candidate): r for r in secrets.scan_secrets(df).collect()}
    assert all(found[(i, h)].is_secret for i, h in enumerate(hexes[:30]))
    assert not any(found[(100 + i, h)].is_secret for i, h in enumerate(hexes[30:]))
    assert not any(r.is_secret for (i, _), r in found.items() if i is not None and 200 <= i < 300)
    labelled = spark.createDataFrame([(h, float(i % 2)) for i, h in enumerate(hexes)], "candidate string, label double")
    assert secrets.scan_secrets(df, labelled).count() == len(found)


def test_secret_scan_runs_no_python(spark):
    plan = secrets.scan_secrets(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- all of them ----


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    results = [
        simhash.near_duplicates(empty),
        substring.repeated_passages(empty),
        packing.pack_tokens(empty, queries.TOKENIZER),
        exact.exact_duplicates(empty),
        secrets.scan_secrets(empty),
        queries.round_trip(empty, queries.TOKENIZER),
        quality.score_quality(empty, labels, score_col="__s"),
        brown.score_texts(empty, brown.F.col("doc_id") % 7 != 2),
        knn.top_k(vectors, knn.F.col("vec_id") % 100 == 0),
        pii.find_personal_data(empty),
        pii.sanitise(empty),
    ]
    for df in results:
        assert df.columns and df.count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    expected = sorted(tuple(dict(zip(columns, r, strict=True))[c] for c in sorted(columns)) for r in cursor.fetchall())
    df = queries.QUERIES[name](spark, SF)
    assert sorted(tuple(r[c] for c in sorted(columns)) for r in df.collect()) == expected and expected


def test_pipeline_agrees_with_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = {r.doc_id: r["__s"] for r in quality.score_quality(docs, labels, score_col="__s").collect()}
    kept = {i: t for i, t in texts.items() if scores[i] >= 0.3}
    by_text = collections.defaultdict(list)
    for i, t in kept.items():
        by_text[t].append(i)
    kept = {max(ids): t for t, ids in by_text.items()}
    fps = {i: plain_fingerprint(t, 4) for i, t in kept.items()}
    of = classes(fps, [(a, b) for a, b in itertools.combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 4])
    kept = {i: t for i, t in kept.items() if of[i] == i}
    result = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in result} == set(kept)
    assert len(corpus_pipeline.STAGES) == 5 and "pipeline" in entry_points.queries()
    tokens = {r.doc_id: r.doc_tokens for r in result}
    pieces = collections.Counter()
    for r in result:
        pieces[r.doc_id] += r.length
    assert pieces == tokens
