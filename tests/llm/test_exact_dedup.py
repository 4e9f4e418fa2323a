"""Exact dedup against a dictionary; the cuckoo filter against a set."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from datescore.llm import exact_dedup as D
from llm_corpus import empty, frame, rows


def _normal(t):
    return re.sub("[\x20\x09-\x0d]", "", t or "")


def _classes(data):
    groups = defaultdict(list)
    for i, t in data:
        groups[_normal(t)].append((-len(t or ""), i is None, i, t))
    return {k: sorted(v, key=lambda x: x[:2] + (x[2] or 0,)) for k, v in groups.items()}


def test_classes_equal_brute_force(spark):
    data = rows()
    got = D.exact_dedup(frame(spark)).collect()
    classes = _classes(data)
    want = Counter()
    for key, members in classes.items():
        for _, _, i, _ in members:
            want[i, members[0][2], len(members), hashlib.sha256(key.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert Counter(r.text_sha256 for r in kept) == Counter(hashlib.sha256(k.encode()).hexdigest() for k in classes)
    assert all(r.doc_id == r.keep_id for r in kept)


def test_keep_one_returns_whole_rows(spark):
    data = rows()
    docs = frame(spark)
    got = D.keep_one(docs)
    assert got.columns == docs.columns
    want = Counter((v[0][2], len(v[0][3] or "")) for v in _classes(data).values())
    assert Counter((r.doc_id, len(r.text or "")) for r in got.collect()) == want


def test_hot_class_and_empty_table(spark):
    hot = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("copy of a copy").alias("text"))
    rest = spark.range(20_000, 40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    got = D.exact_dedup(hot.unionByName(rest))
    assert got.groupBy("kept", "group_size").count().orderBy("group_size", "kept").collect() == [
        (True, 1, 20_000), (False, 20_000, 19_999), (True, 20_000, 1)]
    assert D.exact_dedup(empty(spark)).count() == 0 and D.keep_one(empty(spark)).count() == 0


def _digests(n, start=0):
    return np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(start, start + n)), np.uint8).reshape(-1, 32)


def test_filter_inserts_deletes_and_overflows():
    keys = _digests(5000)
    small = D.CuckooFilter(64)
    assert not small.insert_all(keys)  # 256 places
    f = D.CuckooFilter.of(keys)
    assert f.hits(keys).all() and D.CuckooFilter.load(f.dump()).hits(keys).all()
    assert f.hits(_digests(20_000, 10_000)).mean() < 0.01
    f.delete_all(keys[:2500])
    assert f.hits(keys[2500:]).all() and f.hits(keys[:2500]).mean() < 0.01


def test_index_insertion_deletion_and_resizing(spark):
    def rows_of(ids):
        return spark.createDataFrame([(bytes(_digests(1, i)[0]), i, 10, 1) for i in ids], D.CONTENT)

    def found(index, ids):
        asked = spark.createDataFrame([(bytes(_digests(1, i)[0]), i, 10) for i in ids], "digest binary, doc_id long, n_chars long")
        return {r.doc_id: r.group_size for r in index.probe(asked).collect() if r.found}

    index = D.CuckooIndex(spark, 10)
    index.insert(rows_of(range(1500)))
    index.insert(rows_of(range(1000, 3000)))  # 500 are live already; the filters grow
    assert found(index, range(0, 4000, 250)) == {i: 2 if 1000 <= i < 1500 else 1 for i in range(0, 3000, 250)}
    index.delete(rows_of([0, 1000, 9999]).select("digest"))
    assert set(found(index, [0, 250, 1000, 1250, 9999])) == {250, 1250}


def test_batches_through_one_index(spark):
    """A second batch is judged against what the index holds."""
    a = spark.createDataFrame([(5, "same text"), (6, "other")], "doc_id long, text string")
    b = spark.createDataFrame([(3, "same  text"), (7, "new")], "doc_id long, text string")
    index = D.CuckooIndex(spark, 100)
    D.exact_dedup(a, index).collect()
    got = {r.doc_id: (r.keep_id, r.group_size) for r in D.exact_dedup(b, index).collect()}
    assert got == {3: (3, 2), 7: (7, 1)}


# --- the filter decides ---------------------------------------------------------------------


def test_only_hits_read_the_content():
    """Misses are inserted without a look at the content; hits are verified, copies merged."""
    bucket = D._Bucket()
    new = [(bytes(d), i, 10, 1) for i, d in enumerate(_digests(6000))]
    bucket.put(new)
    false_hits = bucket.reads
    assert len(bucket.content) == 6000 and false_hits < 60
    bucket.put([(d, i + 10_000, 10, 2) for d, i, _, _ in new[:500]])
    assert bucket.reads == false_hits + 500 and len(bucket.content) == 6000
    assert all(bucket.content[d] == (i, 10, 3) for d, i, _, _ in new[:500])
    before = bucket.reads
    assert bucket.probe([bytes(d) for d in _digests(3000, 50_000)]) == [None] * 3000 and bucket.reads - before < 30
    # Copies in one call: the first chunk stores, later ones hit.
    other = D._Bucket()
    other.put([(bytes(_digests(1, 7)[0]), i, 5 + (i == 3), 1) for i in range(10_000)])
    assert list(other.content.values()) == [(3, 6, 10_000)] and other.reads == -(-10_000 // D.CHUNK) - 1


def test_linear_hashing_moves_keys_of_one_bucket():
    h = np.random.default_rng(1).integers(0, 1 << 32, 20_000)
    for n in range(1, 70):
        b, more = D.bucket_number(h, n), D.bucket_number(h, n + 1)
        assert b.min() >= 0 and b.max() < n
        moved = b != more
        assert (more[moved] == n).all() and len(np.unique(b[moved])) <= 1


def test_buckets_are_split_and_only_touched_ones_are_written(spark):
    def rows_of(ids):
        return spark.createDataFrame([(bytes(d), i, 10, 1) for i, d in zip(ids, _digests(len(ids), ids[0]))], D.CONTENT)

    index = D.CuckooIndex(spark, keys_per_bucket=100, least_buckets=2)
    index.insert(rows_of(range(0, 900)))
    assert index.n_buckets == 9 and index.n_keys() == 900
    index.insert(rows_of(range(450, 2600)))
    assert index.n_buckets == 26 and index.n_keys() == 2600
    sizes = [len(r.keep_ids) for r in index.table().collect()]
    assert len(sizes) == 26 and sum(sizes) == 2600 and max(sizes) < 300
    assert {r.bucket for r in index.table().collect()} == set(range(26))
    content = {bytes(d): n for r in index.table().collect() for d, n in zip(D._matrix(bytes(r.digests)), r.group_sizes)}
    assert content == {bytes(d): 2 if 450 <= i < 900 else 1 for i, d in enumerate(_digests(2600))}
    # A small batch writes the buckets it touches.
    index.insert(rows_of([5]))
    last = spark.read.parquet(f"{index.path}/rows/version={index.version}").count()
    assert last == 1 and index.n_keys() == 2600
    for k in range(D.VERSIONS):
        index.insert(rows_of([k]))
    assert index.first > 0 and index.n_keys() == 2600  # written together, old versions are no longer read
    asked = spark.createDataFrame([(bytes(d), i, 10) for i, d in enumerate(_digests(2700))], "digest binary, doc_id long, n_chars long")
    assert sorted(r.doc_id for r in index.probe(asked).collect() if r.found) == list(range(2600))


def test_many_small_batches_equal_one(spark):
    data = rows()
    whole = Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in D.exact_dedup(frame(spark, data)).collect())
    index = D.CuckooIndex(spark, keys_per_bucket=8, least_buckets=1)
    for k in range(0, len(data), 30):
        got = D.exact_dedup(frame(spark, data[k : k + 30]), index)
    keys = D._keys(frame(spark, data))
    again = index.probe(keys).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, bytes(r.digest).hex()) for r in again) == whole
    assert got.count() == len(data) % 30 or 30
