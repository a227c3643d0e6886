"""Whitening, the leaderboard's feed and the quality classifier against brute force, and their defined cases."""

import datetime
import math
import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridfold.llm import leaderboard, quality, queries, whitening

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


# --- 11


def brute_whitening(vectors, k=4):
    x = np.floor(256 * np.stack(vectors).astype(float)).astype(np.int64)
    once = np.unique(x, axis=0)
    n, s = len(once), once.sum(axis=0)
    away = once - s / n
    e, v = np.linalg.eigh(away.T @ away / n)
    e, v = e[::-1], v[:, ::-1]
    return n, ((n * x - s) ** 2).sum(axis=1), (x - s / n) @ v[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


@tables
def test_op11(spark):
    got = queries.op11_whitening(spark, SF).toPandas()
    source = pd.read_parquet(f"{SF}/embeddings.parquet")
    n, deviation, whitened, explained = brute_whitening(source["embedding"])
    assert len(got) == 4 * len(source) and set(got["n"]) == {n} and got["identity_error"].nunique() == 1 and got["identity_error"].max() < 1e-9
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[source["vec_id"]].to_numpy()
    signs = np.sign((wide * whitened).sum(axis=0))
    np.testing.assert_allclose(wide * signs, whitened, atol=1e-9)
    assert (got[got["component"] == 1].set_index("vec_id").loc[source["vec_id"]]["deviation"].to_numpy() == deviation).all()
    np.testing.assert_allclose([got[got["component"] == c]["explained"].iloc[0] for c in (1, 2, 3, 4)], explained, rtol=1e-9)


def test_whitening_of_copies_and_other_widths(spark):
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(40, 70)) * rng.uniform(0.5, 3, 70)).tolist()
    rows = [*enumerate(vectors), *((100 + i, vectors[0]) for i in range(30))]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).toPandas()
    n, _, whitened, _ = brute_whitening([v for _, v in rows])
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[[i for i, _ in rows]].to_numpy()
    assert set(got["n"]) == {n} == {40}
    np.testing.assert_allclose(np.abs(wide), np.abs(whitened), atol=1e-9)


def test_whitening_tiles_add_up():
    """Blocks cut, multiplied and added by hand give the covariance of all, with more tiles than one."""
    rng = np.random.default_rng(3)
    x = rng.integers(-300, 300, (50, 150))
    centre = whitening.Centre(50, x.sum(axis=0).tolist())
    (batch,) = (b for b in whitening._pack(iter([_vectors(x / 256)])))
    blocks = list(whitening._column_blocks(4)(iter([batch])))
    assert sum(b.num_rows for b in blocks) == 6
    v = np.zeros((150, 150))
    for tile in whitening._multiply({150: centre})(iter(blocks)):
        for r in tile.to_pylist():
            a, b = whitening._side(r["i"]), whitening._side(r["j"])
            v[a, b] = np.reshape(r["tile"], v[a, b].shape)
            v[b, a] = v[a, b].T
    away = x - x.mean(axis=0)
    np.testing.assert_allclose(v, away.T @ away, atol=1e-6)


def _vectors(x):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"embedding": pa.array(x.tolist(), pa.list_(pa.float64()))})


def test_whitening_of_awkward_rows(spark):
    rows = [(1, [math.nan, 1.0]), (2, None), (3, [None, 1.0]), (4, []), (5, [1.0, 2.0]), (6, [1.0, 2.0]), (None, [3.0, 1.0]), (8, [1e30, 1.0, 2.0]), (9, [1.0, 5.0, -1e30]), (10, [4.0]), (11, [math.inf])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, n int, component string")
    got = {(r["vec_id"], r["component"]): r for r in whitening.whiten(df).collect()}
    assert sorted(got, key=str) == sorted([(i, c) for i, d in ((5, 2), (6, 2), (None, 2), (8, 3), (9, 3), (10, 1)) for c in range(1, d + 1)], key=str)
    assert got[5, 1]["n"] == 2 and abs(got[5, 1]["whitened"]) == pytest.approx(1) and got[5, 2]["whitened"] is None and got[5, 2]["explained"] == 0
    assert got[8, 1]["deviation"] is None and got[10, 1]["whitened"] is None and got[10, 1]["identity_error"] is None
    assert whitening.whiten(df.limit(0)).count() == 0


# --- 12


def brute_feed(lines, vendors, items):
    """The feed by sorting every nation's whole revenues on each of its days."""
    nn = lambda v: "" if v is None else str(v)
    dealt, latest = [], {}
    for r in lines:
        h = zlib.crc32(",".join(map(nn, (r["sale_id"], r["item_id"], r["vendor_id"], r["line_no"]))).encode())
        s = 19723 + h % 150 if r["shipped_at"] is None else (r["shipped_at"].date() - datetime.date(1970, 1, 1)).days
        a = s + h % 7 + (20 if h % 5 == 0 else 0)
        b = min(8, max(1, 1 + (a - 19723) * 8 // 180))
        dealt.append((b, a, s, r))
        latest[b] = max(latest.get(b, s), s)
    days = defaultdict(lambda: defaultdict(lambda: defaultdict(int)))
    for b, a, s, r in dealt:
        earlier = max((v for k, v in latest.items() if k < b), default=s)
        nation = vendors.get(r["vendor_id"])
        if s + 15 < earlier or nation is None or r["item_id"] not in items:
            continue
        price, q = items[r["item_id"]], r["quantity"]
        v = math.floor(100 * r["amount"] + 0.5) if r["amount"] is not None else q * math.floor(100 * price + 0.5) if None not in (q, price) else 0
        days[nation][a][r["item_id"]] += -v if r["flag"] == "swapped" else v
    out = set()
    for nation, by_day in days.items():
        revenue, old = defaultdict(int), {}
        for a in sorted(by_day):
            for i, v in by_day[a].items():
                revenue[i] += v
            new = {i: k for k, i in enumerate(sorted((i for i, v in revenue.items() if v > 0), key=lambda i: (-revenue[i], i))[:10], 1)}
            for i in old.keys() | new.keys():
                if old.get(i) != new.get(i):
                    change = "enter" if i not in old else "exit" if i not in new else "move"
                    out.add((nation, a, i, min(8, max(1, 1 + (a - 19723) * 8 // 180)), change, old.get(i), new.get(i), revenue[i]))
            old = new
    return out


LINES = "sale_id long, line_no int, item_id long, vendor_id long, quantity int, amount double, discount double, flag string, shipped_at timestamp_ntz, batch int, nation_id string"


def shop(seed=6, n=1_500, items=90):
    """Hot items and vendors, returns that sink items, nulls anywhere, repeated lines."""
    r = random.Random(seed)
    lines = []
    for k in range(n):
        maybe = lambda v: None if r.random() < 0.03 else v
        item = 7 if r.random() < 0.3 else r.randrange(items + 3)
        at = datetime.datetime(2024, 1, 1) + datetime.timedelta(days=r.randrange(150), hours=r.randrange(24))
        lines.append((maybe(k // 3), maybe(k % 3), maybe(item), maybe(1 if r.random() < 0.3 else r.randrange(12)), maybe(r.randrange(1, 9)), maybe(r.randrange(1, 9_000) / 100), 0.0, maybe(r.choice(["swapped", "kept", "kept"])), maybe(at), 3, "clash"))
        if k % 50 == 0:
            lines.append(lines[-1])
    vendors = [(v, "n", None if v == 11 else v % 3, 0.0) for v in range(11)] + [(None, "n", 1, 0.0)]
    return lines, vendors, [(i, "x", None if i % 17 == 0 else i * 1.37) for i in range(items)] + [(None, "x", 1.0)]


def feed_rows(spark, lines, vendors, items):
    df = spark.createDataFrame(lines, LINES)
    found = leaderboard.change_feed(df, spark.createDataFrame(vendors, "vendor_id long, name string, nation_id int, balance double"), spark.createDataFrame(items, "item_id long, name string, price double"))
    names = [x.split()[0] for x in LINES.split(", ")]
    want = brute_feed([dict(zip(names, x, strict=True)) for x in lines], {v[0]: v[2] for v in vendors if v[0] is not None}, {i[0]: i[2] for i in items if i[0] is not None})
    return sorted(map(tuple, found.collect()), key=str), sorted(want, key=str)


def test_the_feed_against_brute_force(spark, monkeypatch):
    """With buckets of four items and nodes of two feeders there are four levels of ladders."""
    monkeypatch.setattr(leaderboard, "ITEMS", 4)
    monkeypatch.setattr(leaderboard, "FAN", 2)
    assert leaderboard.widths(90) == [32, 16, 8, 4, 2, 1]
    monkeypatch.setattr(leaderboard, "widths", lambda n: [8, 2, 1])
    got, want = feed_rows(spark, *shop())
    assert got == want and {x[4] for x in got} == {"enter", "exit", "move"} and len(got) > 300


def test_stores_are_closed_when_their_tasks_are_done(spark, monkeypatch):
    """Each start opens every store anew. Only the first one's buckets, which take prices in, may keep theirs."""
    monkeypatch.setattr(leaderboard, "widths", lambda n: [4, 1])
    loaded = _loaded_stores(spark)
    before = {str(k) for k in loaded()}
    lines, vendors, items = shop(n=400)
    got, want = feed_rows(spark, lines, vendors, items)
    assert got == want and len({x[3] for x in got}) > 2
    assert len({str(k) for k in loaded()} - before) <= 4


def _loaded_stores(spark):
    """What lists the open state stores of this process, which Spark keeps to itself."""
    stores = spark._jvm.org.apache.spark.sql.execution.streaming.state
    module = getattr(getattr(stores, "StateStore$"), "MODULE$")
    field = next(f for f in module.getClass().getDeclaredFields() if f.getName().endswith("loadedProviders"))
    field.setAccessible(True)
    return lambda: list(spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(field.get(module).keySet()))


def test_the_feed_of_nothing(spark):
    lines, vendors, items = shop(n=3)
    assert feed_rows(spark, [], vendors, items) == ([], [])


@tables
def test_op12(spark):
    read = lambda t, keys: [r.asDict() for r in spark.read.parquet(f"{SF}/{t}.parquet").select(*keys).collect()]
    lines = read("sale_lines", ["sale_id", "line_no", "item_id", "vendor_id", "quantity", "amount", "flag", "shipped_at"])
    vendors = {r["vendor_id"]: r["nation_id"] for r in read("vendors", ["vendor_id", "nation_id"])}
    items = {r["item_id"]: r["price"] for r in read("items", ["item_id", "price"])}
    got = [tuple(r) for r in queries.op12_leaderboard(spark, SF).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_feed(lines, vendors, items)


def test_ladders_scan_like_sorting():
    r = random.Random(1)
    ladder, plain = leaderboard.Ladder(), {}
    for _ in range(3_000):
        item, revenue = r.randrange(60), r.choice([r.randrange(-50, 100), r.randrange(1 << 20), 5])
        reached = (plain.__setitem__(item, revenue), ladder.put(item, revenue), ladder.reaches(item))[2]
        best = sorted((i for i, v in plain.items() if v > 0), key=lambda i: (-plain[i], i))[:10]
        if reached:
            ladder.top = ladder.scan()
        assert list(ladder.top) == best and all(ladder.top[i] == plain[i] for i in best)


def test_blobs_round_trip():
    rows = np.array([[1, -5, 1 << 62], [1, 7, -(1 << 62)], [2, 0, 3]], np.int64)
    assert (leaderboard.unpack(leaderboard.pack(rows), 3) == rows).all() and leaderboard.unpack(leaderboard.pack(rows[:0]), 3).shape == (0, 3)


# --- 13


@tables
def test_op13(spark):
    """On the larger of the small tables: held-out rows are ranked nearly always right, and clean ones stay."""
    sf = SF.replace("sf0.001", "sf0.01") if os.path.isdir(SF.replace("sf0.001", "sf0.01")) else SF
    got = queries.op13_quality(spark, sf).toPandas()
    assert len(got) == len(pd.read_parquet(f"{sf}/documents.parquet")) and got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.3)).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    labelled = got.merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    held = labelled[labelled["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() >= 0.95 and held[held["quality"] == 1]["predicted"].mean() >= 0.97


def plain_scores(model, texts):
    """The dot product over a Counter of n-grams, one word at a time."""
    from collections import Counter

    out = []
    for text in texts:
        data = np.frombuffer((text or "").encode(), np.uint8)
        hashes = quality.words(data)
        pairs = [quality.textvec.mix(np.array([quality.TWICE if a == b else a * np.uint64(3) + b]))[0] for a, b in zip(hashes[:-1], hashes[1:], strict=True)]
        counts = Counter(int(h >> np.uint64(64 - quality.BITS)) for h in [*hashes, *pairs])
        total = model.prior + sum(float(model.weights[f]) * c * quality.SCALE / sum(counts.values()) for f, c in counts.items())
        out.append(1 / (1 + math.exp(-total)))
    return out


TEXTS = ["good words here", "GOOD words!! here!!", "", None, "und und und und", "a" * 5_000, "x y " * 4_000, "é😀 ñ", " \n\t ", "good words here"]


def test_scores_against_a_plain_sum(spark):
    with np.errstate(over="ignore"):
        rng = np.random.default_rng(7)
        model = quality.Model(rng.normal(size=1 << quality.BITS).astype(np.float32), 0.3)
        docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, score string")
        got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
        np.testing.assert_allclose([got[i] for i in range(len(TEXTS))], plain_scores(model, TEXTS), rtol=1e-6)


def test_words_split_by_class_whatever_the_slice(monkeypatch):
    data = np.frombuffer("ab cd!! éf|g  hij***k\n".encode() * 9, np.uint8)
    whole = quality.words(data)
    assert len(whole) == 9 * 9
    for size in (1, 2, 7, 30):
        monkeypatch.setattr(quality.textvec, "SLICE", size)
        assert (quality.words(data) == whole).all()


def test_labels_are_taken_once_and_agree(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (2, 1), (3, 0), (None, 1), (4, None), (5, 7), (6, 1)], "doc_id long, quality int")
    got = {tuple(r) for r in quality.sample(labels, F.col("doc_id") != 6, "quality", 100).collect()}
    assert got == {(1, 1), (3, 0)}
    many = spark.range(10_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    assert 500 <= quality.sample(many, F.lit(True), "quality", 1_000).count() <= 1_000


def test_learning_without_labels_and_from_one_kind(spark):
    docs = spark.createDataFrame([(i, f"word{i} und", 1) for i in range(40)], "doc_id long, text string, label int")
    labels = lambda v: spark.createDataFrame([(i, v) for i in range(30)] if v is not None else [], "doc_id long, quality int")
    score = lambda v, d=docs: [r["score"] for r in quality.score(d, quality.fit(d, labels(v), F.lit(True))).collect()]
    assert score(None) == [0.5] * 40 and min(score(1)) > 0.5 and max(score(0)) < 0.5
    assert score(1, docs.limit(0)) == []


# --- what earlier operators had to mend


def clashing(spark):
    rows = [(i, f"line {i % 3}\nown {i}\nshared", i, f"h{i}", -1, "s", "t") for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string, gf_row int, gf_hot string, shard int, slot string, `a.b` string").repartition(3)


def test_line_dedup_with_names_of_its_own(spark):
    from gridfold.llm import linededup

    got = {r["doc_id"]: r for r in linededup.clean(clashing(spark)).collect()}
    assert len(got) == 40 and all(r["kept"] == f"own {i}" and (r["gf_row"], r["gf_hot"], r["a.b"]) == (i, f"h{i}", "t") for i, r in got.items())


def test_shards_are_written_in_slot_order(spark, tmp_path):
    from gridfold.llm import sharding

    sharding.write(clashing(spark), str(tmp_path / "out"), shards=4)
    total = 0
    for folder in (tmp_path / "out").glob("shard=*"):
        slots = [s for f in sorted(folder.glob("*.parquet")) for s in pd.read_parquet(f)["slot"]]
        assert slots == list(range(len(slots)))
        total += len(slots)
    assert total == 40


def test_every_query_has_its_answers_from_small_leaves(spark):
    """300 clusters of 20 and 40 pairs: the nearest leaves of some queries hold less than ten rows."""
    from gridfold.llm import ann

    rng = np.random.default_rng(9)
    centres = rng.normal(size=(340, 8)) * 50
    sizes = [20] * 300 + [2] * 40
    x = np.concatenate([c + rng.normal(size=(n, 8)) * 0.1 for c, n in zip(centres, sizes, strict=True)])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = ann.search(df, F.col("vec_id") >= 5_950).groupBy("query_id").count().collect()
    assert len(got) == 130 and {r["count"] for r in got} == {10}
