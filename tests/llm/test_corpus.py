"""The registered queries against brute force on the smallest tables, and the pipeline's stages."""

import hashlib
import math
import os
import re
import shutil
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from gridfold.llm import jaccard, linededup, lm, mixing, queries, sharding, stages
from tests.llm.test_operators import LOW, ROWS, SCHEMA, base_spans, brute_components, words

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def texts():
    table = pd.read_parquet(f"{SF}/documents.parquet")
    return dict(zip(table["doc_id"].tolist(), [x or "" for x in table["text"]], strict=True))


def rows(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op1(spark, texts):
    for x in rows(spark, "op1_pii"):
        want = base_spans(texts[x["doc_id"]])
        assert x["base_sha256"] == sha(",".join(want)) and set(want) <= set(filter(None, x["spans"].split(",")))
        assert [x[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(w.startswith(k) for w in want) for k in ("email", "ip", "card", "phone")]
        assert x["n_spans"] == len([s for s in x["spans"].split(",") if s])


def test_op2(spark, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    pieces = {}
    seen = set()
    for x in rows(spark, "op2_packing"):
        pieces.setdefault(x["doc_id"], []).append((x["start"], x["length"], x["ids_crc32"], x["doc_tokens"]))
        assert x["offset"] == 0 and x["sequence_id"] not in seen
        seen.add(x["sequence_id"])
    assert set(pieces) == set(texts)
    for doc, found in pieces.items():
        ids = np.array([*tok.encode(texts[doc], add_special_tokens=False).ids, 1], "<u4")
        want, at = [], 0
        while at < len(ids):  # the longest piece that the rest holds, time and again
            size = min(2048, 1 << (len(ids) - at).bit_length() - 1)
            want.append((at, size, zlib.crc32(ids[at : at + size].tobytes()), len(ids)))
            at += size
        assert sorted(found) == want


def hashed(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed=seed)


def chained(values):
    out = 42
    for v in values:
        out = hashed(v.to_bytes(8, "little"), out)
    return out


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_fingerprint(text):
    """hash and word position of each closed syncmer: 5-mers whose least 2-mer is the first or the last."""
    word = [hashed(w.encode()) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    inner = [signed(chained(word[i : i + 2])) for i in range(len(word) - 1)]
    out = []
    for i in range(len(word) - 4):
        around = inner[i : i + 4]
        if min(around) in (around[0], around[3]):
            out.append((chained([x % (1 << 64) for x in around]) >> 32, i))
    return out if out or not word else [(chained(word) >> 32, 0)]


def brute_likeness(a, b):
    first = lambda f: {h: p for h, p in reversed(f)}
    x, y = first(a), first(b)
    if not x or not y:
        return float(x == y)
    common = sorted(set(x) & set(y), key=x.get)
    rank = {h: i for i, h in enumerate(sorted(common, key=y.get))}
    n = len(common)
    return sum(max(0, n - 2 * abs(i - rank[h])) for i, h in enumerate(common)) / (n * len(set(x) | set(y))) if n else 0.0


def test_op3(spark, texts):
    order = sorted(texts, reverse=True)
    spelled = lambda f: "".join(f"{h:08x}{p - q:x}" for (h, p), q in zip(f, [-1, *(p for _, p in f)], strict=False))
    got = {x["doc_id"]: x for x in rows(spark, "op3_fingerprint")}
    assert len(got) == len(texts)
    for i, doc in enumerate(order):
        text, following = texts[doc], texts[order[(i + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = map(brute_fingerprint, (text, edited, following))
        x = got[doc]
        assert (x["n_chars"], x["edited_sha256"]) == (len(text), sha(edited))
        assert (x["fingerprint"], x["edited_fingerprint"]) == (spelled(a), spelled(b))
        assert abs(x["near_edited"] - brute_likeness(a, b)) < 1e-12 and abs(x["near_next"] - brute_likeness(a, c)) < 1e-12


def test_op4(spark, texts):
    got = Counter(tuple(x) for x in rows(spark, "op4_jaccard_join"))
    assert got == brute_components([(d, t) for d, t in texts.items()], 4, 85, 100)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    import duckdb

    duck = duckdb.connect()
    for file in os.listdir(SF):
        duck.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    theirs = duck.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in theirs.description]
    ours = queries.QUERIES[name](spark, SF)
    assert sorted(ours.columns) == sorted(columns)
    assert Counter(map(tuple, ours.select(columns).collect())) == Counter(theirs.fetchall())


def test_op5(spark):
    table = pd.read_parquet(f"{SF}/embeddings.parquet")
    ids, x = table["vec_id"].to_numpy(), np.stack(table["embedding"]).astype(np.float64)
    hits = total = 0
    got = pd.DataFrame([r.asDict() for r in rows(spark, "op5_ann")])
    assert set(got["query_id"]) == {i for i in ids.tolist() if i % 100 == 0}
    for query, found in got.groupby("query_id"):
        d = np.sqrt(((x - x[ids == query][0]) ** 2).sum(1))
        d[ids == query] = np.inf
        best = np.lexsort((ids, d))[:10]
        found = found.sort_values("rank")
        assert found["rank"].tolist() == list(range(1, 11)) and np.array_equal(found["score"], [d[ids == v][0] for v in found["vec_id"]])
        hits += len(set(found["vec_id"]) & set(ids[best]))
        total += 10
    assert hits >= 0.9 * total


def test_op6(spark, texts):
    table = pd.read_parquet(f"{SF}/documents.parquet")
    size = {d: len(words(t)) for d, t in texts.items()}
    of_source = Counter()
    for d, s in zip(table["doc_id"], table["source"], strict=True):
        of_source[s] += size[d]
    names = sorted(of_source, key=lambda s: (s is None, s or ""))
    want = {s: 0.0 for s in names}
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    free, rest = set(names), float(sum(of_source.values()))
    while free:  # water filling: whoever is over the limit is fixed there
        total = sum(weight[s] for s in free)
        over = {s for s in free if rest * weight[s] / total > 3 * of_source[s]}
        if not over:
            want |= {s: rest * weight[s] / total for s in free}
            break
        want |= {s: 3.0 * of_source[s] for s in over}
        rest -= sum(want[s] for s in over)
        free -= over
    source = dict(zip(table["doc_id"], table["source"], strict=True))
    taken = Counter()
    got = rows(spark, "op6_mixing")
    assert sorted(x["doc_id"] for x in got) == sorted(texts)
    for x in got:
        s = source[x["doc_id"]]
        assert (x["size"], x["source_size"]) == (size[x["doc_id"]], of_source[s]) and abs(x["target"] - want[s]) < 1e-6
        assert x["taken"] in (0, *(k * x["size"] for k in (1, 2, 3)))
        taken[s] += x["taken"]
    assert all(abs(taken[s] - want[s]) <= 0.01 * want[s] + 5 for s in names)
    assert Counter(map(tuple, got)) == Counter(map(tuple, rows(spark, "op6_mixing")))


def test_op7(spark, texts):
    table = pd.read_parquet(f"{SF}/documents.parquet")
    lang = dict(zip(table["doc_id"], table["lang"], strict=True))
    got = rows(spark, "op7_language_id")
    assert sorted(x["doc_id"] for x in got) == sorted(texts)
    right = total = 0
    for x in got:
        assert x["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % 3 == 1) and 0 <= x["score"] <= 1
        assert (x["lang_pred"] == "und") == (not any(c.isalpha() for c in texts[x["doc_id"]]))
        if x["held_out"] and isinstance(lang[x["doc_id"]], str):
            right += x["lang_pred"] == lang[x["doc_id"]]
            total += 1
    assert right >= 0.95 * total > 20


def test_op8(spark, texts):
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in texts}
    tokens = {d: [*words(t), None] for d, t in texts.items()}
    c = Counter(w for d, t in tokens.items() if not held[d] for w in t)
    n, v = sum(c.values()), len(c)
    base = score = 0.0
    for x in rows(spark, "op8_lm_scoring"):
        own = tokens[x["doc_id"]]
        want = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        assert (x["held_out"], x["n_tokens"], x["n_known"], x["train_tokens"]) == (held[x["doc_id"]], len(own), sum(c[w] > 0 for w in own), n)
        assert abs(x["base_score"] - want) < 1e-6 * max(1, abs(want)) and -math.inf < x["score"] < 0
        if held[x["doc_id"]]:
            base, score = base + want, score + x["score"]
    assert score > base  # held-out texts are likelier in context


def test_op8_scores_are_the_models(spark, texts):
    """Each text's score, token by token: the model's probability, and beyond the vocabulary the share."""
    df = spark.read.parquet(f"{SF}/documents.parquet")
    training = F.col("doc_id") % 2 == 0
    counts = lm.head_of(lm.count(df, training), 1 << 17)
    model = lm.fit(df, training, counts, vocabulary=50)
    got = {x["doc_id"]: x["score"] for x in lm.score(df, training, head=100, vocabulary=50).collect()}
    c = Counter(w for d, t in texts.items() if d % 2 == 0 for w in [*words(t), None])
    key = lambda w: lm.END if w is None else int(lm._batch_tokens(lm.pa.RecordBatch.from_arrays([lm.pa.array([w])], names=["text"]))[0][0])
    class_of = dict(zip(model.keys.tolist(), model.classes.tolist(), strict=True))
    other = len(model.classes)
    for d in sorted(texts, key=lambda d: len(texts[d]))[:40]:
        own = [*words(texts[d]), None]
        ids = [class_of.get(key(w), other) for w in own]
        total, u, v = 0.0, other - 1, other - 1
        for w, i in zip(own, ids, strict=True):
            total += model.log_probability(np.array([i]), np.array([u]), np.array([v]))[0] / math.log(10)
            total += math.log10(c[w] + 0.1) - model.rest_log10 if i == other else 0.0
            u, v = i, u
        assert abs(got[d] - total) < 1e-3 * abs(total)


def test_op9(spark, texts):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOW)
    seen = Counter(k for t in texts.values() for k in {key(x) for x in t.split("\n")} if k)
    want = Counter()
    for d, t in texts.items():
        kept = [x for x in t.split("\n") if not key(x) or seen[key(x)] < 10]
        want[(d, t.count("\n") + 1, t.count("\n") + 1 - len(kept), sha("\n".join(kept)))] += 1
    assert Counter(map(tuple, rows(spark, "op9_line_dedup"))) == want


def test_op10(spark, texts):
    got = rows(spark, "op10_sharding")
    assert sorted(x["doc_id"] for x in got) == sorted(texts)
    size, slots = Counter(), {}
    by_shard = {}
    for x in got:
        data = texts[x["doc_id"]].encode()
        assert (x["size"], x["text_crc32"], x["law"], x["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        size[x["shard"]] += x["size"]
        slots.setdefault(x["shard"], []).append(x["slot"])
        by_shard.setdefault(x["shard"], []).append(signed(hashed(data)))
    assert set(size) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean, largest = sum(size.values()) / 16, max(len(t.encode()) + 1 for t in texts.values())
    assert all(abs(s - mean) <= 0.02 * mean + largest for s in size.values())
    assert all(max(by_shard[k]) <= min(by_shard[k + 1]) for k in range(15))  # a cut of one order


@pytest.fixture(scope="module")
def partitioned(spark, tmp_path_factory):
    """The same documents, in folders whose files have the same names."""
    out = str(tmp_path_factory.mktemp("parts") / "d")
    df = spark.createDataFrame(ROWS, SCHEMA)
    df.coalesce(1).withColumn("folder", F.pmod(F.xxhash64("text", "doc_id"), F.lit(3))).write.partitionBy("folder").parquet(out)
    return df, spark.read.parquet(out)


def test_rows_are_told_apart_by_their_whole_path(spark, partitioned, monkeypatch):
    plain, folders = partitioned
    assert len({os.path.basename(f) for f in folders.inputFiles()}) < len(folders.inputFiles())
    same = lambda f: Counter(map(tuple, f(folders).collect())) == Counter(map(tuple, f(plain).collect()))
    monkeypatch.setattr(mixing, "FAN", 2)
    assert same(lambda d: jaccard.join(d, most=6).select("doc_id", "n_shingles", "component_id"))
    assert same(lambda d: lm.score(d, head=5, vocabulary=5).select("doc_id", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6)))
    assert same(lambda d: linededup.clean(d, min_docs=3).select("doc_id", "n_lines", "n_dropped", "kept"))
    assert same(lambda d: sharding.assign(d, 4).groupBy("doc_id", "size", "text_crc32").count())
    assert same(lambda d: mixing.mix(d, block=4).groupBy("source", "source_size", "target").agg(F.count("*")))
    assert same(lambda d: stages.jaccard_join(spark, d, SF).select("text").distinct())
    assert folders.count() == linededup.with_row(folders).select("gf_row").distinct().count()


def test_rows_that_are_no_files_rows_are_written_first(spark, partitioned):
    _, folders = partitioned
    twice = folders.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    assert linededup.with_row(twice).select("gf_row").distinct().count() == 2 * folders.count()


def test_the_rest_stands_without_this_package(tmp_path):
    root = Path(__file__).parents[2]
    shutil.copytree(root / "gridfold", tmp_path / "gridfold", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    entry = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), any(n.startswith('op') or n == 'pipeline' for n in q))"
    run = lambda: subprocess.run([sys.executable, "-c", entry], cwd=tmp_path, capture_output=True, text=True)
    assert run().stdout.split()[2] == "False"
    shutil.copy(root / "corpus_pipeline.py", tmp_path)
    assert run().stdout.split()[2] == "False"
    (tmp_path / "gridfold/llm").mkdir()
    (tmp_path / "gridfold/llm/__init__.py").write_text("")
    (tmp_path / "gridfold/llm/queries.py").write_text("import no_such_module")
    assert "no_such_module" in run().stderr  # a fault within the package isn't taken for its absence


# --- stages


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


TEXTS = Counter((d, t or "") for d, t, *_ in ROWS)


def kept(df):
    assert df.columns == list(stages.COLUMNS)
    return df.collect()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_of_an_empty_table(spark, name, stage):
    got = stage(spark, spark.createDataFrame([], SCHEMA), SF)
    assert got.count() == 0 and ("ids_crc32" in got.columns if name == "packing" else got.columns == list(stages.COLUMNS))


def test_language_stage_drops_what_has_no_letter(spark, docs):
    got = kept(stages.language_id(spark, docs, SF))
    lettered = Counter({k: n for k, n in TEXTS.items() if any(c.isalpha() for c in k[1])})
    gone = lettered - Counter((x["doc_id"], x["text"]) for x in got)
    assert len(got) == sum(lettered.values()) - len(gone) and {d for d, _ in gone} <= {70, 73}  # in no language that is known here
    assert all(x["lang"] for x in got)


def test_line_stage(spark, docs):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOW)
    seen = Counter(k for _, t, *_ in ROWS for k in {key(x) for x in (t or "").split("\n")} if k)
    clean = lambda t: "\n".join(x for x in (t or "").split("\n") if not key(x) or seen[key(x)] < 10)
    want = Counter((d, clean(t), lang, source, len(clean(t))) for d, t, lang, source, *_ in ROWS)
    assert Counter((x["doc_id"], x["text"], x["lang"], x["source"], x["n_chars"]) for x in kept(stages.line_dedup(spark, docs, SF))) == want


def test_jaccard_stage_keeps_one_of_each_group(spark, docs):
    places = [(i, t) for i, (_, t, *_) in enumerate(ROWS)]  # components by position, for ids repeat
    component = {i: c for i, _, c in brute_components(places, 5, 80, 100)}
    want = Counter()
    for c in set(component.values()):
        group = [ROWS[i] for i in component if component[i] == c]
        want[min((d for d, *_ in group if d is not None), default=None)] += 1
    got = kept(stages.jaccard_join(spark, docs, SF))
    assert Counter(x["doc_id"] for x in got) == want


def test_mix_stage_meets_targets(spark, docs):
    got = kept(stages.mix(spark, docs, SF))
    times = Counter((x["doc_id"], x["text"] or "") for x in got)
    assert all(times[k] <= 3 * n for k, n in TEXTS.items())
    sizes = Counter()
    for _, t, _, s, *_ in ROWS:
        sizes[s] += len(words(t))
    target, taken = mixing.targets(dict(sizes), (1, 2, 3)), Counter()
    for x in got:
        taken[x["source"]] += len(words(x["text"]))
    largest = max(len(words(t)) for _, t, *_ in ROWS)
    assert all(abs(taken[s] - target[s]) <= largest for s in sizes)


def test_pack_stage_keeps_all_tokens(spark, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    got = stages.pack(spark, docs, SF).collect()
    assert sum(x["length"] for x in got) == sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in ROWS)
    assert all(x["length"] & (x["length"] - 1) == 0 and x["length"] <= 2048 for x in got)


def test_pipeline_runs_its_stages_in_order(spark, texts):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "line dedup", "n-gram Jaccard join", "mixing", "packing"]
    got = corpus_pipeline.run(spark, SF).collect()
    docs = {x["doc_id"] for x in got}
    assert docs <= set(texts) and len(docs) > 0.5 * len(texts)
    letters = {d for d, t in texts.items() if any(c.isalpha() for c in t)}
    assert docs <= letters
