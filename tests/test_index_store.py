"""The stored vector index: versions, deltas, compaction, and refreshes by digest."""

from __future__ import annotations

import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tessera.operators import refresh, search
from tessera.session import scratch_path
from tessera.sources.index_store import IndexStore

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def table(spark, rows):
    return spark.createDataFrame(rows, "id string, version int, value double, embedding array<float>")


def rows_of(ids, version, shift=0.0):
    return [(str(i), version, i + shift, [float(i), shift]) for i in ids]


def stored(store, number=None):
    return {r.id: (r.version, r.value) for r in store.read(number).collect()}


def files_below(store, folder):
    listed = store._fs.listFiles(store._path(folder), True)
    total = 0
    while listed.hasNext():
        total += listed.next().getLen()
    return total


def test_an_upsert_writes_only_its_rows(spark):
    store = IndexStore(spark, scratch_path(spark, "index"), buckets=4)
    assert store.read() is None and store.version() is None
    _, n = store.upsert(table(spark, rows_of(range(2000), 1)), "version")
    assert n == 2000
    version, n = store.upsert(table(spark, rows_of(range(1990, 2010), 2, 0.5)), "version")
    assert n == 20 and len(version.deltas) == 1
    assert files_below(store, version.deltas[0]) < files_below(store, next(iter(version.bases))) / 4
    expected = {r[0]: (r[1], r[2]) for r in rows_of(range(2000), 1) + rows_of(range(1990, 2010), 2, 0.5)}
    assert stored(store) == expected
    # older rows and repeats in one batch
    mixed = rows_of([3], 0, 9.0) + rows_of([4], 1, 9.0) + rows_of([5, 5], 3, 1.0) + rows_of([5], 4, 2.0) + [("6", None, 1.0, None)]
    _, n = store.upsert(table(spark, mixed), "version")
    expected |= {"4": (1, 13.0), "5": (4, 7.0)}
    assert n == 2 and stored(store) == expected


def test_readers_keep_their_version(spark):
    store = IndexStore(spark, scratch_path(spark, "index"), buckets=2)
    store.replace(table(spark, rows_of(range(10), 1)))
    before = store.read()
    store.apply(table(spark, rows_of([3], 2, 0.5)), table(spark, rows_of([7, 3, 99], 0)))
    after = {r[0]: (r[1], r[2]) for r in rows_of(range(10), 1) if r[0] != "7"} | {"3": (2, 3.5)}
    assert stored(store) == after and before.count() == 10 and len(stored(store, 0)) == 10
    store.apply(table(spark, rows_of([7], 5)))
    assert stored(store) == after | {"7": (5, 7.0)}


@pytest.mark.parametrize("broken", ["_write", "_publish"])
def test_a_write_that_stops_leaves_the_version_before(spark, broken, monkeypatch):
    store = IndexStore(spark, scratch_path(spark, "index"), buckets=2)
    store.replace(table(spark, rows_of(range(10), 1)))
    real = getattr(IndexStore, broken)

    def stop(self, *args):
        if broken == "_write":
            real(self, *args)
        raise OSError("lost")

    for write in (lambda s: s.upsert(table(spark, rows_of([1], 2, 0.5)), "version"), lambda s: s.replace(table(spark, rows_of([1], 2))), lambda s: s.apply(table(spark, rows_of([1], 2)))):
        with monkeypatch.context() as m, pytest.raises(OSError):
            m.setattr(IndexStore, broken, stop)
            write(store)
        assert stored(store) == {r[0]: (r[1], r[2]) for r in rows_of(range(10), 1)}
    store.upsert(table(spark, rows_of([1], 2, 0.5)), "version")
    assert stored(store)["1"] == (2, 1.5)
    assert store.clean(1) > 0 and stored(store)["1"] == (2, 1.5) and len(store.numbers()) == 1


def test_two_writers_cannot_take_one_number(spark):
    root = scratch_path(spark, "index")
    store = IndexStore(spark, root, buckets=2)
    first, _ = store.replace(table(spark, rows_of(range(3), 1)))
    with pytest.raises(RuntimeError):
        store._publish(first)
    assert stored(store) == {str(i): (1, float(i)) for i in range(3)}


def test_compaction_rewrites_touched_buckets_only(spark):
    store = IndexStore(spark, scratch_path(spark, "index"), buckets=8)
    store.replace(table(spark, rows_of(range(200), 1)))
    bucket = {r.id: r.b for r in store.read().select("id", store.bucket("id", 8).alias("b")).collect()}
    mine = [i for i in range(200) if bucket[str(i)] == 3]
    store.apply(table(spark, rows_of(mine[:2], 2, 0.5)), table(spark, rows_of(mine[2:3], 0)))
    store.apply(table(spark, rows_of(mine[:1], 3, 0.25)))
    expected = stored(store)
    version = store.compact()
    assert version.deltas == [] and sorted(map(len, version.bases.values())) == [1, 7]
    assert stored(store) == expected and len(expected) == 199 and expected[str(mine[0])] == (3, mine[0] + 0.25)
    assert store.compact() == version
    store.clean(1)
    assert stored(store) == expected


def test_edges(spark):
    store = IndexStore(spark, scratch_path(spark, "index"), buckets=2)
    with pytest.raises(ValueError):
        store.apply(table(spark, []))
    store.upsert(table(spark, []), "version")
    assert store.read().count() == 0
    _, n = store.apply(table(spark, rows_of([1], 1)).withColumn("other", F.lit(1)))
    assert n == 1 and store.read().columns == ["id", "version", "value", "embedding"]
    with pytest.raises(Exception, match="row without id"):
        store.upsert(spark.createDataFrame([(None, 1, 1.0, None)], "id string, version int, value double, embedding array<float>"), "version")
    assert stored(store) == {"1": (1, 1.0)}


class Counting(search.LetterProfile):
    """Counts the texts that it is given, in a folder that all tasks share."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self, texts):
        import uuid

        with open(f"{self.folder}/{uuid.uuid4().hex}", "w") as out:
            out.write("\n".join(texts))
        return super().__call__(texts)


def test_refresh_encodes_new_texts_only(spark, tmp_path):
    def documents(rows):
        return spark.createDataFrame(rows, "id string, document string, place string")

    def encoded_by(store, docs):
        seen = tmp_path / str(len(list(tmp_path.iterdir())))
        seen.mkdir()
        done = refresh.refresh_index(store, docs, lambda: Counting(str(seen)))
        return done, sorted(t for f in seen.iterdir() for t in f.read_text().split("\n"))

    def shown(df):
        return sorted((r.id, r.document or "", r.place or "", tuple(np.asarray(r.embedding).tolist())) for r in df.collect())

    rows = [(f"d{i}", f"text {chr(97 + i % 26)}{i}", "a") for i in range(200)] + [("x1", "same", None), ("x2", "same", "b")]
    store = IndexStore(spark, scratch_path(spark, "index"), buckets=4)
    done, texts = encoded_by(store, documents(rows))
    assert (done.changed, done.encoded, done.removed) == (202, 201, 0) and len(texts) == 201
    done, texts = encoded_by(store, documents(rows))
    assert (done.changed, done.encoded, done.removed) == (0, 0, 0) and texts == [] and len(store.numbers()) == 2
    later = [*rows[5:], ("d0", "a new one", "a"), ("d1", "same", "a"), ("new", rows[9][1], "c")]
    later = [(i, t, "moved") if i == "d7" else (i, t, p) for i, t, p in later]
    done, texts = encoded_by(store, documents(later))
    assert (done.changed, done.encoded, done.removed) == (4, 1, 3) and texts == ["a new one"]
    fresh = search.embed(documents(later), "document", search.LetterProfile)
    assert shown(store.read()) == shown(fresh)
    store.compact()
    assert shown(store.read()) == shown(fresh)
    done, _ = encoded_by(store, documents([("n", None, None), ("e", "", None)]))
    assert (done.changed, done.encoded) == (2, 1) and shown(store.read()) == shown(search.embed(documents([("n", None, None), ("e", "", None)]), "document", search.LetterProfile))
