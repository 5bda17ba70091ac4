"""Cached vectors, retries, and vectors filled in again after a change of dimension."""

import datetime as dt
import tempfile

import pytest

from sheaf.operators.embed import BatchEncoder, HashingEncoder, embed
from sheaf.operators.vector_cache import VectorCache, embed_cached
from sheaf.plans.store import FilingStore

TEXT = "k int, content string"


def _vectors(df):
    return {r.k: r.embedding for r in df.select("k", "embedding").collect()}


def test_only_new_texts_are_encoded(spark):
    cache = VectorCache(spark, tempfile.mkdtemp(prefix="sheaf-vec-"))
    one = spark.createDataFrame([(1, "river pumps"), (2, "stone"), (3, "stone"), (4, None), (5, "")], TEXT)
    enc = HashingEncoder(16)
    got, n = embed_cached(one, cache, encoder=enc)
    assert n == 3 and _vectors(got) == _vectors(embed(one.fillna(""), encoder=enc))
    assert embed_cached(one, cache, encoder=enc)[1] == 0
    more, n = embed_cached(spark.createDataFrame([(6, "stone"), (7, "valve")], TEXT), cache, encoder=enc)
    assert n == 1 and len(_vectors(more)) == 2
    assert embed_cached(one, cache, encoder=HashingEncoder(8))[1] == 3              # another encoder's are not these
    assert embed_cached(one.limit(0), cache, encoder=enc)[1] == 0


def test_failures_are_not_kept_and_retries_wait(spark):
    marker = tempfile.mkdtemp(prefix="sheaf-tries-")

    def factory():
        import os

        def encode(texts):
            if "bad" in texts:
                raise RuntimeError("x" * 400)
            if "late" in texts and not os.path.exists(f"{marker}/seen"):
                open(f"{marker}/seen", "w").close()
                raise RuntimeError("not yet")
            return [[3.0, 4.0]] * len(texts)
        return encode
    enc = BatchEncoder(factory, dim=2, batch_size=1, retries=1, backoff_s=0.01)
    cache = VectorCache(spark, tempfile.mkdtemp(prefix="sheaf-vec-"))
    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "late")], TEXT).coalesce(1)
    for n in (3, 1):                                                                # only the failed one again
        got, count = embed_cached(df, cache, encoder=enc, error_col="error")
        rows = {r.k: (r.embedding is not None, r.error) for r in got.collect()}
        assert count == n and rows == {1: (True, None), 2: (False, "x" * 400), 3: (True, None)}
    with pytest.raises(ValueError):
        BatchEncoder(factory, dim=2, retries=-1)


def test_vectors_are_filled_in_after_a_change_of_dimension(spark):
    store = FilingStore(spark, tempfile.mkdtemp(prefix="sheaf-k8-"), dim=8)
    f = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 2, False, 0)], "accession_number string, processed_at timestamp, chunk_count int, deleted boolean, batch_id long")
    c = spark.createDataFrame([("a", 0, "river", 0), ("a", 1, "stone", 0)], "accession_number string, chunk_index int, content string, batch_id long")
    store.write_batch(f, embed(c, encoder=HashingEncoder(8)))
    store.change_dimension(4)
    cache = VectorCache(spark, tempfile.mkdtemp(prefix="sheaf-vec-"))
    assert store.chunks().filter("embedding IS NOT NULL").count() == 0
    assert store.fill_vectors(HashingEncoder(4), cache) == 2
    assert {len(r.embedding) for r in store.chunks().collect()} == {4} and store.index_ready()
    assert embed_cached(c, cache, encoder=HashingEncoder(4))[1] == 0                # the cache holds them now


def test_a_querys_prompt_and_the_choice_of_an_encoder(spark):
    from sheaf.operators.embed import encode_query, get_encoder

    def factory(max_seq_length):
        return lambda texts: [[float(len(t)), float(max_seq_length)] for t in texts]
    enc = get_encoder("batch", factory=factory, dim=2, query_prefix="ask: ", max_seq_length=10)
    asked, told = encode_query(spark, "four", enc), embed(spark.createDataFrame([(1, "four")], TEXT), encoder=enc).first().embedding
    assert asked[0] / asked[1] == pytest.approx(0.9) and told[0] / told[1] == pytest.approx(0.4)
    assert get_encoder("hashing", dim=8) == HashingEncoder(8)
    with pytest.raises(ValueError, match="unsupported embedding backend"):
        get_encoder("other")


def test_a_stream_of_small_batches_is_merged(spark):
    store = FilingStore(spark, tempfile.mkdtemp(prefix="sheaf-merge-"), key_buckets=2, term_buckets=2, merge_factor=3)
    for k in range(5):
        f = spark.createDataFrame([(f"f{k}", dt.datetime(2024, 1, 1), 1, False, k)], "accession_number string, processed_at timestamp, chunk_count int, deleted boolean, batch_id long")
        c = spark.createDataFrame([(f"f{k}", 0, f"text {k}", k)], "accession_number string, chunk_index int, content string, batch_id long")
        store.write_batch(f, c, "run", k)
    assert len(store.snapshot().entries) == 3 and store.chunks().count() == 5 and store.index_ready()


def test_texts_are_written_once(spark, monkeypatch):
    from sheaf.operators import vector_cache

    kept = vector_cache.stored
    wrote = {}
    monkeypatch.setattr(vector_cache, "stored", lambda df, name: (wrote.setdefault(name, df.columns), kept(df, name))[1])
    cache = VectorCache(spark, tempfile.mkdtemp(prefix="sheaf-vec-"))
    one = spark.createDataFrame([(1, "river pumps"), (2, "stone"), (3, None)], TEXT)
    assert embed_cached(one, cache, encoder=HashingEncoder(8))[1] == 3
    got, n = embed_cached(one.union(spark.createDataFrame([(4, "valve")], TEXT)), cache, encoder=HashingEncoder(8))
    assert n == 1 and len(_vectors(got)) == 4 and None not in _vectors(got).values()
    assert [name for name, columns in wrote.items() if "_text" in columns] == ["texts"]
