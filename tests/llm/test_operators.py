"""Each operator against a plain version of it on a small table."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fieldtally.llm import embeddings, exact, mixing, packing, sharding, simhash
from fieldtally.llm.common import bucket_count, components, running_totals
from fieldtally.llm.tokens import ids_of, marked_ids_of, tokenizer_path

WHITE = " \t\n\x0b\x0c\r"


def rows_of(frame):
    return [r.asDict() for r in frame.collect()]


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# Shared ---------------------------------------------------------------------------------

def test_running_totals_over_a_hot_group(spark):
    rows = [("hot" if i % 10 else "cold", (i * 7919) % 1000, i % 5) for i in range(1000)]
    frame = spark.createDataFrame(rows, "g string, k bigint, v bigint")
    got = {(r["g"], r["k"]): (r["before"], r["total"]) for r in running_totals(
        frame, "g", "k", [], F.col("v"), 16, span=1000).collect()}
    for g in ("hot", "cold"):
        total = 0
        for _, k, v in sorted(r for r in rows if r[0] == g):
            assert got[g, k] == (total, sum(r[2] for r in rows if r[0] == g))
            total += v


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [
        (200, 201), (201, 202), (202, 200), (300, 300), (139, 41), (139, 500)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    links_only = [ab for ab in links if ab[0] != ab[1]]
    want = roots({n for ab in links_only for n in ab}, links_only)
    assert {r["node"]: r["root"] for r in components(frame).collect()} == want


def test_no_links_have_no_components(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# Sharding -------------------------------------------------------------------------------

def check_shards(rows, shards):
    sizes = Counter(r["shard"] for r in rows)
    counts = [sizes.get(s, 0) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))


def test_shards_hold_the_mixture(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    rows = rows_of(sharding.shard_documents(docs, 10))
    check_shards(rows, 10)
    whole = Counter(r["source"] for r in rows)
    for s in range(10):
        held = Counter(r["source"] for r in rows if r["shard"] == s)
        assert all(abs(held[k] - n / 10) <= 1.5 for k, n in whole.items())
    again = rows_of(sharding.shard_documents(docs.repartition(5), 10))
    key = lambda r: (r["doc_id"], r["shard"], r["slot"])
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_shards_by_the_plain_rule(documents):
    """Ranks within sources in MD5 order, then all by fractional rank."""
    rows = rows_of(documents.select("doc_id", "source"))
    by = defaultdict(list)
    for r in rows:
        by["1" if r["source"] is None else "0" + r["source"]].append(r)
    order = []
    for source, some in by.items():
        some.sort(key=lambda r: (hashlib.md5(f"20:{r['doc_id']}".encode()).hexdigest()[:15], r["doc_id"]))
        order += [((2 * i + 1) / (2 * len(some)), source, i, r["doc_id"]) for i, r in enumerate(some)]
    want = {o[3]: p * 7 // len(order) for p, o in enumerate(sorted(order))}
    got = rows_of(sharding.shard_documents(documents, 7))
    assert {r["doc_id"]: r["shard"] for r in got} == want


def test_shards_of_odd_and_empty_tables(odd, documents):
    named = odd.withColumns({"total": F.col("n_chars") * 3, "block": F.lit("b")})
    rows = rows_of(sharding.shard_documents(named, 400))
    passed = [c for c in named.columns if c not in ("shard", "slot")]
    tell = lambda found: Counter(tuple(r[c] for c in passed) for r in found)
    assert tell(rows) == tell(rows_of(named))
    assert set(rows[0]) == set(named.columns)
    check_shards(rows, 400)
    assert sharding.shard_documents(documents.limit(0), 4).count() == 0


def test_shards_are_written_in_slot_order(documents, tmp_path):
    sharded = sharding.shard_documents(documents, 3)
    sharding.write_shards(sharded, str(tmp_path / "shards"))
    back = documents.sparkSession.read.parquet(str(tmp_path / "shards"))
    assert back.count() == documents.count()
    assert {p.name for p in (tmp_path / "shards").glob("shard=*")} == {f"shard={i}" for i in range(3)}


# Mixing ---------------------------------------------------------------------------------

def word_number(text):
    return len((text or "").encode().split())


def plain_targets(sizes):
    """Shares by weight, the excess over three times a source reshared in a loop."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full, target = sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        free = sum(w for s, w in weights.items() if s not in full)
        target = {s: 3 * sizes[s] if s in full else rest * weights[s] / free for s in names}
        over = {s for s in names if target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def check_mix(docs, block=mixing.BLOCK_WORDS):
    sources, spans = mixing.mix(docs, block=block)
    targets = {r["source_key"]: r for r in sources.collect()}
    sizes = defaultdict(int)
    for r in rows_of(docs.select("source", "text")):
        sizes[r["source"]] += word_number(r["text"])
    for s, want in plain_targets(sizes).items():
        got = targets["1" if s is None else "0" + s]
        assert got["source_size"] == sizes[s] and got["target"] == pytest.approx(want, abs=1e-6)
    taken, each = Counter(), Counter()
    for r in rows_of(spans):
        if r["length"] is not None:
            assert 0 <= r["begin"] and r["length"] > 0 and r["begin"] + r["length"] <= r["size"]
            taken[r["source_key"]] += r["length"]
            each[r["doc_id"], r["source"], r["size"], r["copy"]] += r["length"]
    for k, t in targets.items():
        assert abs(taken[k] - t["target"]) <= 3 * block
    assert all(n <= 3 * k[2] for k, n in each.items())
    return spans


def test_mix_comes_near_its_targets(documents, odd):
    spans = check_mix(documents, block=16)
    assert {r["doc_id"] for r in spans.select("doc_id").distinct().collect()} == {
        r["doc_id"] for r in documents.collect()}
    check_mix(odd, block=16)


def test_a_slot_takes_one_block_and_reruns_agree(documents):
    spans = mixing.mix(documents, block=16)[1]
    per_slot = Counter()
    for r in rows_of(spans.where("slot is not null")):
        per_slot[r["slot"]] += r["length"]
    assert set(per_slot.values()) <= set(range(17)) and Counter(per_slot.values())[16] > 0.9 * len(per_slot)
    key = lambda r: str(r)
    again = mixing.mix(documents.repartition(3), block=16)[1]
    assert sorted(rows_of(spans), key=key) == sorted(rows_of(again), key=key)


def test_mix_without_words(spark, documents):
    empty = documents.where("false")
    assert mixing.mix(empty)[1].count() == 0 and mixing.mix(empty)[0].count() == 0
    bare = documents.where("doc_id in (200, 201, 202)")
    sources, spans = mixing.mix(bare)
    assert all(r["target"] == 0 for r in sources.collect())
    assert spans.select("doc_id").distinct().count() == 3
    assert spans.where("slot is not null").count() == 0


# SimHash --------------------------------------------------------------------------------

def plain_fingerprint(text, width=4):
    words = [w for w in (text or "").encode().lower().split()]
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, seed=42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def test_fingerprints(spark, documents):
    texts = [r["text"] for r in documents.collect()] + ["É a b c d É", "A\x1cB c", "one"]
    for text in texts:
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    one = spark.createDataFrame([("a b c d",)], "t string").select(F.xxhash64("t")).first()[0]
    assert simhash.fingerprint("A b C d") == one % 2 ** 64


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_simhash_components(which, request):
    docs = request.getfixturevalue(which)
    got = rows_of(simhash.simhash_dedup(docs))
    texts = rows_of(docs.select("doc_id", "text"))
    assert len(got) == len(texts)
    fps = {plain_fingerprint(r["text"]) for r in texts}
    ids = defaultdict(list)
    root = roots(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4])
    for r in texts:
        ids[root[plain_fingerprint(r["text"])]].append(r["doc_id"])
    want = Counter((r["doc_id"], plain_fingerprint(r["text"]),
                    min((i for i in ids[root[plain_fingerprint(r["text"])]] if i is not None), default=None))
                   for r in texts)
    assert Counter((r["doc_id"], r["fp"] % 2 ** 64, r["component_id"]) for r in got) == want
    assert len(set(map(str, want))) > 20


@pytest.mark.parametrize("part_size", [4, 64, 4096])
def test_links_join_all_near_fingerprints(spark, monkeypatch, part_size):
    monkeypatch.setattr(simhash, "PART_SIZE", part_size)
    rng = np.random.default_rng(part_size)
    base = rng.integers(0, 2 ** 63, 50)
    fps = set()
    for _ in range(500):
        x = int(rng.choice(base))
        for b in rng.integers(0, 64, rng.integers(0, 6)):
            x ^= 1 << int(b)
        fps.add(x - 2 ** 64 if x >= 2 ** 63 else x)
    links = simhash.near_links(spark.createDataFrame([(x,) for x in fps], "fp bigint"))
    pairs = [(r["a"], r["b"]) for r in links.collect()]
    near = [(a, b) for a in fps for b in fps if a < b and ((a ^ b) % 2 ** 64).bit_count() <= 4]
    assert roots(fps, pairs) == roots(fps, near)


def test_a_dense_ball_is_one_component_without_comparing_all_pairs():
    rng = np.random.default_rng(1)
    ball = np.unique(np.array([0x1234 ^ sum({1 << int(b) for b in rng.integers(0, 64, 3)})
                               for _ in range(20000)], dtype=np.uint64))
    left, right = simhash.trie_links(ball, np.ones(len(ball), dtype=bool), 2, 4)
    assert len(left) == len(ball) - 1 and set(right.tolist()) == {0}


def test_simhash_of_an_empty_table(documents):
    assert simhash.simhash_dedup(documents.limit(0)).count() == 0


# Embeddings -----------------------------------------------------------------------------

def plain_links(rows, threshold=0.95):
    good = {}
    for i, (_, e) in enumerate(rows):
        if e and all(x is not None and np.isfinite(x) for x in e) and any(e):
            v = np.array(e, dtype=float)
            good[i] = v / np.linalg.norm(v)
    return [(i, j) for i in good for j in good
            if i < j and len(good[i]) == len(good[j]) and good[i] @ good[j] >= threshold]


@pytest.mark.parametrize("block_rows", [8, 2048])
def test_embedding_links(spark, monkeypatch, block_rows):
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((25, 16))
    rows = [(i, (centres[i % 25] + 0.15 * rng.standard_normal(16)).astype(np.float32).tolist())
            for i in range(200)]
    rows += [(300 + i, rows[0][1]) for i in range(40)]
    rows += [(400, None), (401, []), (402, [0.0] * 16), (403, [1.0] * 15 + [float("nan")]),
             (404, [1.0] * 15 + [None]), (405, [float("inf")] + [1.0] * 15), (406, [1.0, 2.0]),
             (407, [2.0, 4.0]), (-1, rows[7][1]), (408, [1e30] * 16), (409, [1e-30] * 16)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("links", F.lit(1))
    got = {r["vec_id"]: r for r in embeddings.embedding_dedup(frame, recall=0.9999999).collect()}
    links = plain_links([(i, None if e is None else [x if x is None else float(np.float32(x)) for x in e])
                         for i, e in rows])
    count = Counter(i for ab in links for i in ab)
    root = roots([i for i, _ in rows], [(rows[a][0], rows[b][0]) for a, b in links])
    assert len(got) == len(rows)
    for n, (i, _) in enumerate(rows):
        assert got[i]["n_links"] == count[n], i
        assert got[i]["component_id"] == root[i] and got[i]["kept"] == (root[i] == i)


def test_embedding_recall_at_the_threshold():
    bits, tables = embeddings.table_shape(1_000_000)
    agree = 1 - np.arccos(0.95) / np.pi
    assert 1 - (1 - agree ** bits) ** tables >= 0.999


def test_recall_of_planted_pairs_at_the_default(spark):
    """20,000 vectors, of which 1,000 pairs have a cosine from 0.95 to 0.96."""
    rng = np.random.default_rng(3)
    unit = rng.standard_normal((20_000, 32))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    for i in range(1000):
        side = unit[10_000 + i] - (unit[10_000 + i] @ unit[i]) * unit[i]
        cosine = 0.9501 + 0.0099 * i / 1000
        unit[10_000 + i] = cosine * unit[i] + math.sqrt(1 - cosine ** 2) * side / np.linalg.norm(side)
    unit = unit.astype(np.float32).astype(np.float64)
    exact_unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    links = np.zeros(len(unit), dtype=int)
    for begin in range(0, len(unit), 2000):
        links[begin:begin + 2000] = (exact_unit[begin:begin + 2000] @ exact_unit.T >= 0.95).sum(axis=1) - 1
    assert links.sum() >= 2000
    frame = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(unit)), "embedding": unit.tolist()}),
                                  "vec_id bigint, embedding array<float>")
    got = {x["vec_id"]: x["n_links"] for x in embeddings.embedding_dedup(frame).collect()}
    assert all(got[i] <= n for i, n in enumerate(links.tolist()))
    assert sum(got.values()) >= 0.99 * links.sum()


def test_signatures_of_very_large_vectors():
    small = np.random.default_rng(1).standard_normal((50, 16))
    with np.errstate(all="raise"):
        large = embeddings.signatures(small / np.abs(small).max() * 1.7e308, 8, 5, 50)
    assert (large == embeddings.signatures(small, 8, 5, 50)).all()


def test_embeddings_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert embeddings.embedding_dedup(empty).count() == 0
    nulls = spark.createDataFrame([(None, None), (None, None)], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in embeddings.embedding_dedup(nulls).collect()] == [(None, 0, None, True)] * 2


# Exact dedup ----------------------------------------------------------------------------

def bare(text):
    return "".join(c for c in text or "" if c not in WHITE)


@pytest.mark.parametrize("fan_in", [2, 8])
def test_exact_classes(documents, fan_in):
    rows = rows_of(documents)
    groups = defaultdict(list)
    for r in rows:
        groups[bare(r["text"])].append(r)
    got = {r["doc_id"]: r for r in rows_of(exact.exact_dedup(documents.repartition(9), fan_in))}
    assert len(got) == len(rows)
    for text, group in groups.items():
        keep = min(group, key=lambda r: (-len(r["text"] or ""), r["doc_id"]))["doc_id"]
        for r in group:
            g = got[r["doc_id"]]
            assert (g["keep_id"], g["group_size"], g["kept"]) == (keep, len(group), r["doc_id"] == keep)
            assert g["digest"] == hashlib.sha256(text.encode()).digest()


def test_exact_of_odd_rows_keeps_one_a_class(odd):
    rows = rows_of(exact.exact_dedup(odd))
    assert len(rows) == odd.count()
    assert Counter(bytes(r["digest"]) for r in rows if r["kept"]) == Counter({bytes(r["digest"]): 1 for r in rows})
    assert exact.exact_dedup(odd.limit(0)).count() == 0

def test_runs_are_exchanged_by_node_and_merged_as_streams(documents):
    rows = exact.digests(documents.repartition(9))
    plan = exact.merge_runs(rows, 9)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line and "REPARTITION_BY_NUM" in line]
    assert len(exchanges) == 3 and sum("node" in e and "digest" not in e.split("node")[0] for e in exchanges) == 2
    names = ["digest", "letters", "check", "less", "unknown", "doc_id", "rows", "node"]
    run = [(b"a", 1, 1, -3, False, 4, 2, 0)] * 3 + [(b"b", 1, 1, -1, True, None, 1, 0)] + [
        (b"b", 1, 2, -1, False, 7, 1, 0)] * 4
    for size in (1, 2, 3, 8):
        batches = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in run[i:i + size]], pa.schema([
            ("digest", pa.binary()), *((n, pa.int64()) for n in names[1:4]), ("unknown", pa.bool_()),
            *((n, pa.int64()) for n in names[5:])])) for i in range(0, len(run), size)]
        merged = [tuple(r.values()) for b in exact._merged(iter(batches)) for r in b.to_pylist()]
        assert merged == [(b"a", 1, 1, -3, False, 4, 6, 0), (b"b", 1, 1, -1, True, None, 1, 0),
                          (b"b", 1, 2, -1, False, 7, 4, 0)]
    assert list(exact._merged(iter([]))) == []



# Packing --------------------------------------------------------------------------------

@pytest.mark.parametrize("which", ["documents", "odd"])
def test_pieces_hold_each_id_once(which, request):
    docs = request.getfixturevalue(which)
    encode = marked_ids_of(tokenizer_path())
    end = np.array([1], dtype="<u4").tobytes()
    pieces = rows_of(packing.pack(docs, length=64))
    want = Counter((r["doc_id"], zlib.crc32(encode(r["text"] or "") + end)) for r in rows_of(docs))
    whole, held = Counter(), {}
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        ids = bytes(r["ids"])
        assert len(ids) == 4 * r["length"] and 0 < r["length"] <= 64
        begun = held.pop(r["doc_id"], b"") if r["start"] else b""
        assert len(begun) == 4 * r["start"]
        begun += ids
        if len(begun) == 4 * r["doc_tokens"]:
            whole[r["doc_id"], zlib.crc32(begun)] += 1
        else:
            held[r["doc_id"]] = begun
    assert whole == want and not held
    used = defaultdict(list)
    for r in pieces:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    short = 0
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
        short += at < 64
    assert short <= 1


def test_neighbours_on_the_curve_are_next_to_each_other():
    side = np.arange(8)
    cells = np.stack(np.meshgrid(side, side, side), axis=-1).reshape(-1, 3)
    order = np.argsort(packing.hilbert_key(cells, 3))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()
    assert sorted(packing.hilbert_key(cells, 3)) == list(range(512))


def test_ids_are_the_vocabulary_s(documents):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokenizer_path())
    encode = ids_of(tokenizer_path())
    odd_texts = ["", " ", "a  b", "a \n b", " x", "x ", "a\n\nb", "don't  stop 'll", "日本 語\t x",
                 "1 2 ４ x1y2 !! \r\n z", "a\x1cb \x1c c", "tab\tand\xa0 space"]
    for text in [r["text"] or "" for r in documents.collect()] + odd_texts:
        ids = np.array(plain.encode(text, add_special_tokens=False).ids, dtype="<u4")
        assert encode(text) == ids.tobytes()


def test_added_tokens_have_their_ids():
    encode = marked_ids_of(tokenizer_path())
    reader = Tokenizer.from_file(tokenizer_path())
    mark = "<|endoftext|>"
    for text in ("hi " + mark + " there", mark, mark * 2, mark + "\n\n  x", "x  " + mark, "a" + mark + "b",
                 "<|endoftext", "<|endoftext|", "<" + mark + ">", "", " ", "x \n " + mark + " \n y"):
        want = reader.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), dtype="<u4").tolist() == want


def test_packing_an_empty_table(documents):
    assert packing.pack(documents.limit(0)).count() == 0


def test_bucket_numbers_follow_the_rows():
    assert bucket_count(0) == bucket_count(511) == 1 and bucket_count(51200) == 100
