"""The ten operators against brute force, on tables with every awkward row that they define."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridfold.llm import ann, boosting, bytebpe, fingerprint, jaccard, langid, linededup, lm, mixing, packing, pii, sharding
from gridfold.llm.components import components
from gridfold.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, kept string"


def table():
    """Null ids, texts, languages and sources; empty, blank, long and repeated rows; copies, near copies."""
    r = random.Random(8)
    vocab = {"en": "the of and to in that is with shall upon from".split(), "de": "der die und das nicht über für schön ist ein".split()}
    text = lambda lang, n: " ".join(r.choice(vocab[lang]) + r.choice(["", "", "s", "er"]) for _ in range(n))
    rows = []
    for i in range(60):
        lang = "en" if i % 2 else "de"
        body = "\n".join(text(lang, r.randint(3, 30)) for _ in range(r.randint(1, 4)))
        rows.append((i, body + ("\n License  TERMS\t" if i % 3 == 0 else ""), lang, f"s{i % 4}"))
    long = text("en", 9_000)
    rows += [(60, None, "en", "s0"), (61, "", None, None), (62, " \t\n ", "en", "s1"), (63, long, "en", "s1"), (64, long, "en", None), (65, "word", "de", "s2"), (66, "1234 !!", None, "s2")]
    near = rows[63][1].split(" ")
    near[4_000] = "other"
    rows += [(67, " ".join(near), "en", "s3"), (68, rows[5][1].upper(), "en", "s3"), (5, rows[5][1], "en", "s1"), (None, "ohne nummer und text", "de", "s1"), (None, None, None, None)]
    rows += [(70, "é" * 5 + " 😀 ñandú", "es", "s0"), (71, "a b c", "en", "s0"), (72, "a b c", "en", "s0"), (73, "<|endoftext|> it's  \n\n we'll", "en", "s0")]
    return [(*x, len(x[1] or ""), 7, 3, "clash") for x in rows]


ROWS = table()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall((text or "").translate(LOW))


# --- 1


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(number))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": lambda m, d: True, "ip": lambda m, d: all(int(x) <= 255 for x in m.group().split(".")), "card": lambda m, d: 13 <= len(d) <= 19 and luhn(d), "phone": lambda m, d: 9 <= len(d) <= 15}
            if good[kind](m, digits):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii_base_spans_are_exact(spark, docs, none):
    r = random.Random(3)
    parts = ["+", "1", "2", "(", ")", " ", "-", ".", "@", "a", "b.c", "0", "255", "999", "4111 1111 1111 1111", "4111-1111-1111-1111", "x@y.z", "é", "😀", "\n", "1.2.3.4", "+1 (555) 123-4567"]
    texts = [None, "", "9" * 5_000, "a" * 5_000 + "@b.c", "1." * 2_000] + ["".join(r.choice(parts) for _ in range(r.randint(1, 25))) for _ in range(400)]
    got = pii.digest(pii.detect(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()
    for x in got:
        want = base_spans(texts[x["doc_id"]] or "")
        assert x["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(filter(None, x["spans"].split(",")))
        assert [x[f"n_{k}"] for k in BASE] == [sum(w.startswith(k) for w in want) for k in BASE]
    assert pii.detect(docs).count() == len(ROWS) and pii.detect(none).count() == 0


def test_pii_of_a_text_with_very_many_spans(spark):
    text = "mail bob.x@foo.com or call +1 (555) 123-4567 now, (030) 123-4567\n" * 3_000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = pii.digest(pii.detect(df)).first()
    assert got["base_sha256"] == hashlib.sha256(",".join(base_spans(text)).encode()).hexdigest() and (got["n_email"], got["n_phone"]) == (3_000, 3_000)
    places = [x.split(":") for x in got["spans"].split(",")]
    assert len(places) == got["n_spans"] and all(text[int(a) : int(b)] in ("bob.x@foo.com", "+1 (555) 123-4567", "(030) 123-4567") for _, a, b in places)
    assert pii.redact(df).first()["text"].startswith("mail [email] or call [phone] now, ")


def test_pii_adds_other_spellings_and_leaves_lookalikes(spark):
    found = ["my tel is (030) 123-4567 ok", "write to bob (at) foo (dot) com now", "server 2001:0db8:85a3:0000:0000:8a2e:0370:7334 up"]
    clean = ["score 12-34", "on 2024-05-17 we", "lives at home.yes he", "at 12:30:45 we", "ISBN 978-3-1614-8410-0"]
    got = {r["doc_id"]: r["text"] for r in pii.redact(spark.createDataFrame(list(enumerate(found + clean)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(3)] == ["my tel is [phone] ok", "write to [email] now", "server [ip] up"]
    assert [got[3 + i] for i in range(len(clean))] == clean


def test_boosting_learns_an_interaction_and_spells_it():
    x = np.random.default_rng(0).random((400, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    trees = boosting.fit(x, y)
    assert ((boosting.margin(trees, x) > 0) == y).mean() > 0.95
    assert boosting.sql(trees[0], ["a", "b", "c"]).startswith("IF(")


# --- 2


def test_packing_round_trip(docs, none):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    got = packing.pack(docs, tokenizer_path(), 256).collect()
    want = Counter(tuple(tok.encode(t or "", add_special_tokens=False).ids + [1]) for _, t, *_ in ROWS)
    pieces = {}
    for p in got:
        ids = np.frombuffer(p["ids"], "<u4")
        assert len(ids) == p["length"] and p["length"] & (p["length"] - 1) == 0 and p["length"] <= 256 and p["offset"] == 0
        pieces.setdefault((p["doc_id"], p["doc_tokens"], p["start"]), []).append(tuple(ids.tolist()))
    assert len({p["sequence_id"] for p in got}) == len(got)
    single = [x for x in want if len(x) < 256]
    for doc in single[:40]:
        at, rest = 0, []
        while at < len(doc):
            size = 1 << (len(doc) - at).bit_length() - 1
            rest.append(doc[at : at + size])
            at += size
        assert all(any(piece in v for v in pieces.values()) for piece in rest)
    assert sum(p["length"] for p in got) == sum(len(k) * v for k, v in want.items())
    assert packing.pack(none, tokenizer_path()).count() == 0


def test_ids_equal_the_librarys():
    from tokenizers import Tokenizer

    r, tok = random.Random(1), Tokenizer.from_file(tokenizer_path())
    parts = ["'", "s", "t", "re", "ll", " ", "  ", "\n", "\t", "a", "B", "é", "9", "२", "!", "?", "中", "<|endoftext|>", "\x1c", "ve", "\r\n", "😀"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(4_000)]
    coder = bytebpe.ByteBpe(tokenizer_path(), remember=300)
    for low in range(0, len(texts), 1_000):
        part = texts[low : low + 1_000]
        ids, count = coder.encode(part)
        assert [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])] == [e.ids for e in tok.encode_batch(part, add_special_tokens=False)]


def test_ids_of_every_code_point_equal_the_librarys():
    from tokenizers import Tokenizer

    tok, coder = Tokenizer.from_file(tokenizer_path()), bytebpe.load(tokenizer_path())
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i <= 0xDFFF]
    texts = ["".join(f"a{c}1 {c}" for c in points[i : i + 64]) for i in range(0, len(points), 64)]
    for low in range(0, len(texts), 2_048):
        ids, count = coder.encode(texts[low : low + 2_048])
        assert [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])] == [e.ids for e in tok.encode_batch(texts[low : low + 2_048], add_special_tokens=False)]


# --- 3


def test_fingerprints(docs, none):
    got = fingerprint.compare_edited(docs).collect()
    assert len(got) == len(ROWS)
    ids = [x[0] for x in ROWS]
    by_id = {x["doc_id"]: x for x in got if ids.count(x["doc_id"]) == 1}
    texts = {i: t or "" for i, t, *_ in ROWS}
    known = sorted({i for i in ids if i is not None}, reverse=True)
    for a, b in zip(known, known[1:], strict=False):
        if ids.count(a) == ids.count(b) == 1:
            t, half = texts[a], len(texts[a]) // 2
            assert by_id[a]["edited_sha256"] == hashlib.sha256((t[: len(t) - half] + texts[b][:half]).encode()).hexdigest()
            assert by_id[a]["n_chars"] == len(t)
    assert by_id[63]["fingerprint"] == by_id[64]["fingerprint"] and by_id[64]["near_next"] == 1
    assert by_id[61]["fingerprint"] == "" and by_id[62]["near_next"] == 1 and by_id[63]["near_next"] == 0
    assert all(0 <= x[c] <= 1 for x in got for c in ("near_edited", "near_next"))
    assert fingerprint.compare_edited(none).count() == 0


def test_anchors_are_closed_syncmers_and_local(spark):
    words_ = [f"w{i * 7919 % 101}x{i}" for i in range(300)]
    edited = [*words_[:150], "x", "y", *words_[150:]]
    df = spark.createDataFrame([(" ".join(words_), " ".join(edited))], "a string, b string")
    a, b = ([x >> 32 for x in found] for found in df.select(fingerprint.anchors(F.col("a")), fingerprint.anchors(F.col("b"))).first())
    k = fingerprint.K
    assert 0.3 * len(words_) < len(a) < 0.7 * len(words_)
    assert len(set(a) - set(b)) <= k and len(set(b) - set(a)) <= k + 2


def test_every_text_with_words_has_an_anchor(spark):
    texts = [" ".join(f"t{i}n{n}w{j}" for j in range(n)) for n in range(1, 9) for i in range(40)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(fingerprint.anchors(F.col("text")).alias("a"))
    found = [tuple(x >> 32 for x in r["a"]) for r in df.collect()]
    assert all(found) and len(set(found)) == len(texts)


def test_a_passage_shared_by_long_texts_is_found(spark):
    r = random.Random(4)
    fresh = lambda n: " ".join(f"w{r.randrange(10**9)}" for _ in range(n))
    shared = fresh(50)
    df = spark.createDataFrame([(i, f"{fresh(4_000)} {shared} {fresh(4_000)}") for i in range(2)], "doc_id long, text string")
    both = fingerprint.fingerprint(df).select("fingerprint", fingerprint.anchors(F.col("text")).alias("a")).collect()
    for x in both:
        digits = [x["fingerprint"][i : i + 9] for i in range(0, len(x["fingerprint"]), 9)]
        assert [int(d[:8], 16) for d in digits] == [a >> 32 & 0xFFFFFFFF for a in x["a"]]
        assert (np.cumsum([int(d[8], 16) for d in digits]) - 1).tolist() == [a & 0xFFFFFFFF for a in x["a"]]
    first, second = ({a >> 32 for a in x["a"]} for x in both)
    got = {x["doc_id"]: x["near_next"] for x in fingerprint.compare_edited(df).collect()}
    assert len(first & second) > 10 and abs(got[1] - len(first & second) / len(first | second)) < 1e-12


def test_likeness_goes_by_position(spark):
    r = random.Random(5)
    passage = [" ".join(f"w{r.randrange(10**9)}" for _ in range(400)) for _ in range(3)]
    cases = {"same": passage, "swapped": [passage[1], passage[0]], "inserted": [passage[0], passage[2], passage[1]]}
    base = " ".join(passage[:2])
    df = spark.createDataFrame([(k, base, base if k == "same" else " ".join(v)) for k, v in cases.items()], "k string, a string, b string")
    near = lambda x, y: fingerprint.likeness(fingerprint.anchors(F.col(x)), fingerprint.anchors(F.col(y)))
    got = {x["k"]: (x["n"], x["m"]) for x in df.select("k", near("a", "b").alias("n"), near("b", "a").alias("m")).collect()}
    assert all(n == m for n, m in got.values())
    assert got["same"][0] == 1 and got["swapped"][0] < 0.05 and 0.6 < got["inserted"][0] < 0.7


def test_one_far_id_and_many_equal_ones_make_no_large_group(spark):
    ids = [*range(600), *[7] * 500, 1 << 50, -(1 << 63), (1 << 63) - 1, *[None] * 300]
    df = spark.createDataFrame([(d, f"text {i} " * 9) for i, d in enumerate(ids)], "doc_id long, text string").repartition(3)
    found = fingerprint.followed(df, 50)
    assert found.groupBy("range").count().agg(F.max("count")).first()[0] <= 110
    rows = found.select("doc_id", "text", "next_text").collect()
    assert Counter(x["text"] for x in rows) == Counter(x["next_text"] for x in rows) == Counter(f"text {i} " * 9 for i in range(len(ids)))
    text_of = {d: f"text {i} " * 9 for i, d in enumerate(ids) if ids.count(d) == 1}
    following = {x["doc_id"]: x["next_text"] for x in rows if ids.count(x["doc_id"]) == 1}
    known = sorted(text_of, reverse=True)
    assert all(following[a] == text_of[b] for a, b in zip(known, known[1:], strict=False) if not a > 7 > b)


# --- 4


def brute_components(rows, n, num, den):
    sets = []
    for _, t, *_ in rows:
        w = words(t)
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                parent[root(i)] = root(j)
    groups = {}
    for i, (doc, *_) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return Counter((rows[i][0], len(sets[i]), least[root(i)]) for i in range(len(rows)))


@pytest.mark.parametrize("most", [2_048, 6])
def test_jaccard_join(spark, docs, none, most):
    got = jaccard.join(docs, most=most).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == brute_components(ROWS, 4, 85, 100)
    if most > 6:
        assert jaccard.join(none).count() == 0
        return
    r = random.Random(2)
    base = [f"v{r.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(60):  # a cloud of near copies at all distances, larger than a task may hold
        w = list(base)
        for _ in range(r.randrange(0, 9)):
            w[r.randrange(len(w))] = f"z{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), most=most).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == brute_components(rows, 4, 85, 100)


def test_regions_join_exactly():
    rule, r = jaccard.Rule(), np.random.default_rng(3)
    for _ in range(6):
        centres = [r.choice(4_000, 80, replace=False) for _ in range(12)]
        sets = []
        for i in range(160):
            n = int(r.integers(0, 16))
            sets.append(np.unique(np.concatenate([centres[i % 12][n:], r.integers(4_000, 10_000, n)])))
        gram = np.concatenate(sets).astype(np.uint64)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        region = jaccard.Region(gram, row, len(sets), rule)
        region.solve(np.arange(len(sets)), np.zeros(0, np.int64))
        roots = region.roots(np.arange(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                inter = len(np.intersect1d(sets[i], sets[j]))
                if 100 * inter >= 85 * (len(sets[i]) + len(sets[j]) - inter):
                    assert roots[i] == roots[j]


def region_of(sets):
    gram, row = np.concatenate(sets).astype(np.uint64), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    return jaccard.Region(gram, row, len(sets), jaccard.Rule())


def chained(r, n_chains, length=6, size=100, step=8):
    """Chains of sets, each the one before with ``step`` n-grams replaced: neighbours are linked (0.852), no others."""
    sets, fresh = [], 10**6
    for _ in range(n_chains):
        one = r.choice(10**6, size, replace=False)
        for k in range(length):
            sets.append(np.sort(one))
            one = one.copy()
            one[k * step : (k + 1) * step] = np.arange(fresh, fresh + step)
            fresh += step
    return sets


@pytest.mark.parametrize("way", ["solve", "one_by_one"])
def test_regions_join_their_windows(way):
    r = np.random.default_rng(6)
    p, k1, w = chained(r, 1, 3)
    region = region_of([p, k1, w])
    getattr(region, way)(np.array([0, 1]), np.array([2]))
    assert len(set(region.roots(np.arange(3)).tolist())) == 1
    for chains in (2, 5, 20):
        sets = chained(r, chains)
        overlap = lambda i, j: len(np.intersect1d(sets[i], sets[j]))
        every = np.arange(len(sets))
        pairs = [(i, j) for i in every for j in every[:i] if 100 * (o := overlap(i, j)) >= 85 * (200 - o)]
        for _ in range(6):
            kernel = r.random(len(sets)) < 0.6
            region = region_of(sets)
            order = r.permutation(every)
            getattr(region, way)(order[kernel[order]], order[~kernel[order]])
            roots = region.roots(every)
            assert all(roots[i] == roots[j] for i, j in pairs if kernel[i] or kernel[j])


def test_links_survive_large_regions(spark, monkeypatch):
    """Regions above what a task holds: ties to one pivot, links to the next size band and across pivots."""
    monkeypatch.setattr(jaccard, "JOB_PIVOTS", 3)
    r = random.Random(11)
    rows = []
    for group in range(6):
        base = [f"g{group}v{k}" for k in range(100 + 4 * group)]
        for _ in range(14):  # copies of copies, some longer: chains within and across size bands
            w = list(base)
            for _ in range(r.randrange(1, 3)):
                w[r.randrange(len(w))] = f"z{r.randrange(10**6)}"
            w += [f"y{r.randrange(10**6)}" for _ in range(r.choice([0, 0, 5, 9, 12]))]
            rows.append((len(rows), " ".join(w)))
            if r.random() < 0.5:
                base = w[: 130 + group]
    members = spark.createDataFrame([(1, i, len(t.split()) - 3, t) for i, t in rows], "pivot long, class long, size long, text string")
    want = {i: least for (i, _, least), _ in brute_components(rows, 4, 85, 100).items()}
    assert 6 < len(set(want.values())) < 60
    for most in (8, 30):
        got = {x["node"]: x["root"] for x in components(jaccard.links(members, jaccard.Rule(), most)).collect()}
        assert {i: got.get(i, i) for i in want} == want


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_components_do_not_stop_halfway(spark):
    with pytest.raises(RuntimeError, match="settle"):
        components(spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long"), most=2)


# --- 5


def test_ann(spark):
    r = np.random.default_rng(4)
    x = r.standard_normal((900, 16)).astype(np.float32)
    x[100:400] = x[100]  # a third alike
    rows = [(i, v.tolist(), "e") for i, v in enumerate(x)]
    rows += [(900, None, "e"), (901, [0.0] * 16, "e"), (902, [float("nan")] * 16, "e"), (903, [1.0, 2.0], "e"), (None, [1.0] * 16, "e"), (904, [None] + [1.0] * 15, "e")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, leaf string").repartition(3)
    got = ann.search(df, F.col("vec_id") % 50 == 0, cell_rows=64).collect()
    hits = total = 0
    d64 = x.astype(np.float64)
    for q in range(0, 900, 50):
        d = np.sqrt(((d64 - d64[q]) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(900), d))[:10]
        mine = sorted((g["rank"], g["vec_id"], g["score"]) for g in got if g["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11)) and all(d[m[1]] == m[2] for m in mine)
        hits += len({m[1] for m in mine} & set(best.tolist()))
        total += 10
    assert hits >= 0.9 * total and {g["query_id"] for g in got} == set(range(0, 900, 50))
    assert ann.search(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0
    few = ann.search(df.where("vec_id < 4"), F.col("vec_id") == 0).collect()
    assert sorted(g["vec_id"] for g in few) == [1, 2, 3]
    assert Counter(map(tuple, got)) == Counter(map(tuple, ann.search(df, F.col("vec_id") % 50 == 0, cell_rows=64, cell_asks=3).collect()))


def test_ann_searches_each_length(spark):
    rows = [(i, [float(i), 1.0] if i % 3 else [float(i), 1.0, 2.0]) for i in range(40)] + [(99, [])]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") < 2, k=3).collect()
    assert {(g["query_id"], g["rank"]): g["vec_id"] for g in got} == {(0, 1): 3, (0, 2): 6, (0, 3): 9, (1, 1): 2, (1, 2): 4, (1, 3): 5}


def test_ann_leaves_grow_and_recall_holds(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    r = np.random.default_rng(0)
    x = (r.standard_normal((300, 24))[r.integers(0, 300, 50_000)] + 0.6 * r.standard_normal((50_000, 24))).astype(np.float32)
    pq.write_table(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 24).cast(pa.list_(pa.float32()))}), tmp_path / "v.parquet")
    got = ann.search(spark.read.parquet(str(tmp_path / "v.parquet")), F.col("vec_id") % 500 == 0, sample_rows=10_000).collect()
    found = Counter()
    for q in range(0, len(x), 500):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        found[q] = len({g["vec_id"] for g in got if g["query_id"] == q} & set(np.argpartition(d, 10)[:10].tolist()))
    assert sum(found.values()) >= 0.9 * 10 * len(found)
    assert ann.sample_size(10**9) > 8 * ann.sample_size(10**6)


# --- 6


def test_mixing(docs, none):
    got = mixing.mix(docs).collect()
    assert Counter((g["doc_id"], g["source"], g["size"]) for g in got) == Counter((d, s, len(words(t))) for d, t, _, s, *_ in ROWS)
    assert all(g["taken"] == g["times"] * g["size"] and 0 <= g["times"] <= 3 for g in got)
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(docs).collect()))
    assert mixing.mix(none).count() == 0


def test_mixing_meets_targets_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN", 4)
    df = spark.range(6_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), (F.pmod(F.xxhash64("id"), F.lit(300)) + 1).alias("size"))
    got = mixing.mix_sizes(df, block=100).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("w"), F.sum("times").alias("n"), F.count("*").alias("docs"), F.first("source_size").alias("s")).collect()
    for g in got:
        assert abs(g["t"] - g["w"]) < 0.001 * g["w"] and abs(g["n"] - g["docs"] * g["w"] / g["s"]) < 8


def test_mixing_takes_rows_in_their_own_order():
    """Blocks and the landing come out the same however rows arrive, ties and null ids included."""
    import pyarrow as pa

    r = np.random.default_rng(9)
    size = r.integers(0, 4, 200)
    table_ = pa.table({"doc_id": pa.array([None if i % 5 == 0 else i // 2 for i in range(200)], pa.int64()), "size": size, "gf_row": [f"f#{i}" for i in range(200)], "mix_rank": size % 3, "mix_p": r.random(200)})
    keep = ["doc_id", "size", "gf_row"]
    one, two = (dict(zip(t["gf_row"].to_pylist(), t["mix_p"].to_pylist(), strict=True)) for t in (mixing.settle(table_.take(r.permutation(200)), keep, ("s", "1"), 0) for _ in range(2)))
    assert one == two


def test_targets_are_capped_and_reshared():
    assert mixing.targets({"a": 100, "b": 10, None: 10}, (1, 2, 3)) == {"a": 60.0, "b": 30.0, None: 30.0}
    assert mixing.targets({"a": 0}, (1,)) == {"a": 0.0} and mixing.targets({}, (1,)) == {}


def test_flight_keeps_both_totals():
    r = np.random.default_rng(5)
    p, size = r.random(500), r.integers(1, 2_000, 500)
    q = mixing.flight(p, size, r)
    assert abs(q.sum() - p.sum()) < 1e-6 and abs((q * size).sum() - (p * size).sum()) < 1e-3
    assert ((q > 0) & (q < 1)).sum() <= 2


# --- 7


def test_language_id(docs, none):
    got = langid.predict(docs, langid.fit(docs)).collect()
    assert len(got) == len(ROWS) and got[0]["kept"] == "clash"
    for g in got:
        letters = any(c.isalpha() for c in g["text"] or "")
        assert (g["lang_pred"] == "und") == (not letters) and 0 <= g["score"] <= 1
        if letters and g["doc_id"] is not None and g["doc_id"] < 60:
            assert g["lang_pred"] == g["lang"]
    assert langid.predict(none, langid.fit(none)).count() == 0
    assert {g["lang_pred"] for g in langid.predict(docs, langid.fit(none)).collect()} == {"und"}


def test_language_id_learns_from_whole_texts(spark):
    """What tells the languages apart stands behind 20,000 like characters."""
    rows = [(i, "same words here " * 1_250 + ("zqx zqqx " if i % 2 else "abba bab ") * 400, "xx" if i % 2 else "yy") for i in range(6)]
    trees = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    new = spark.createDataFrame([(0, "zqx zqqx zqx"), (1, "bab abba bab")], "doc_id long, text string")
    assert {g["doc_id"]: g["lang_pred"] for g in langid.predict(new, trees).collect()} == {0: "xx", 1: "yy"}


def test_language_samples_are_bounded_and_of_different_texts(spark):
    rows = [(i, "the same text" if i % 3 else f"text number {i}", "a" if i % 2 else "b") for i in range(4_000)]
    got = langid.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3), F.lit(True), 20).collect()
    assert len({tuple(x) for x in got}) == len(got) and all(15 <= n <= 20 for n in Counter(x["lang"] for x in got).values())


def test_code_lengths_are_those_of_the_trees():
    text = {"a": b"abracadabra abracadabra", "b": b"banana bandana band"}
    trees = langid.learn(text)

    def bits(sample, t):
        counts = [Counter() for _ in range(4)]
        for i in range(len(sample)):
            for k in range(4):
                counts[k][(bytes(k - min(i, k)) + sample[max(0, i - k) : i], sample[i])] += 1
        total = 0.0
        for i, c in enumerate(t):
            for k in (3, 2, 1, 0):
                context = bytes(k - min(i, k)) + t[max(0, i - k) : i]
                follow = {b: n for (x, b), n in counts[k].items() if x == context}
                if not follow:
                    continue
                n, d = sum(follow.values()), len(follow)
                if c in follow:
                    total += math.log2((n + d) / follow[c])
                    break
                total += math.log2((n + d) / d)
            else:
                total += 8
        return total

    for t in (b"abra", b"bandana!", b"", b"xyz abr", b"banana" * 50):
        got = langid.score(trees, np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0]
        assert np.allclose(got, [bits(text["a"], t), bits(text["b"], t)], rtol=1e-4)


# --- 8


def test_lm_counts_and_base(docs, none):
    got = lm.score(docs, vocabulary=40, head=60).collect()
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0 for d, *_ in ROWS]
    tokens = [[*words(t), None] for _, t, *_ in ROWS]
    c = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((-1 if d is None else d, h, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6)) for (d, *_), h, t in zip(ROWS, held, tokens, strict=True))
    assert sorted((-1 if g["doc_id"] is None else g["doc_id"], *g[1:5], round(g["base_score"], 6)) for g in got) == want
    assert all(g["score"] < 0 for g in got) and lm.score(none).count() == 0


def test_lm_probabilities_sum_to_one():
    r = np.random.default_rng(1)
    first, second, bias, target = (r.standard_normal(s) for s in ((9, 4), (9, 4), 9, (9, 4)))
    contexts = lm.contexts_of(7)
    model = lm.Model(np.arange(7), np.arange(7), contexts, first, second, bias, target, lm.normalisers(first, second, bias, target, block=4), 0.0)
    u, v, w = (x.ravel() for x in np.meshgrid(*[np.arange(9)] * 3, indexing="ij"))
    assert np.allclose(np.exp(model.log_probability(w, u, v)).reshape(9, 9, 9).sum(2), 1, atol=1e-9)


def test_lm_vocabulary_grows_and_rare_words_share_contexts():
    assert lm.vocabulary_of(10**5) == lm.LEAST_WORDS and lm.vocabulary_of(10**12) > 10 * lm.vocabulary_of(10**9) > 100 * lm.LEAST_WORDS / 10
    contexts = lm.contexts_of(9_000)
    assert contexts[: lm.CONTEXTS].tolist() == list(range(lm.CONTEXTS)) and (np.diff(contexts) >= 0).all() and contexts[-1] < lm.CONTEXTS + 20
    assert lm.contexts_of(0).tolist() == [0, 1] and lm.contexts_of(3).tolist() == [0, 1, 2, 3, 4]


def test_lm_without_training_rows(spark, docs):
    got = lm.score(docs, F.lit(False)).collect()
    assert len(got) == len(ROWS) and all(math.isfinite(g["score"]) and g["score"] <= 0 and g["train_tokens"] == g["n_known"] == 0 for g in got)


def test_lm_learns_what_follows():
    r = np.random.default_rng(2)
    ids = np.zeros(20_000, np.int64)
    for i in range(1, len(ids)):  # each token is followed by the next one, nine times in ten
        ids[i] = (ids[i - 1] + 1) % 8 if r.random() < 0.9 else r.integers(8)
    counts = np.append(np.bincount(ids, minlength=8), [1, 1]).astype(float)
    learnt = lm.train(ids, np.zeros(len(ids), bool), counts, dim=8, noise=16, batch=64)
    model = lm.Model(np.arange(8), np.arange(9), lm.contexts_of(8), *learnt, lm.normalisers(*learnt), 0.0)
    assert model.log_probability(ids[2:], ids[1:-1], ids[:-2]).mean() > np.log(1 / 8) + 0.8


def test_lm_learns_from_every_token(spark, monkeypatch):
    """However large the table and however long a text: the last round takes all tokens of all training rows."""
    seen, plain = [], lm.learn_round
    monkeypatch.setattr(lm, "learn_round", lambda *a: (out := plain(*a), seen.append(out[1]))[0])
    texts = [" ".join(f"w{(i * j) % 50}" for j in range(200)) for i in range(40)] + ["far " * 6_000 + "past the cut " * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    counts = lm.head_of(lm.count(df, F.lit(True)), 1_000)
    lm.fit(df, F.lit(True), counts, sample_tokens=1_000)
    assert seen[-1] == counts.tokens == sum(len(t.split()) + 1 for t in texts)
    rows = (trainer := lm.Trainer(np.ones(9))).rows()
    trainer.set_rows(rows)
    assert trainer.rows() == rows


def test_lm_learns_past_a_long_texts_start(spark):
    """What follows "past" stands only beyond a text's first 16,384 characters."""
    df = spark.createDataFrame([(i, "far away " * 2_000 + "past cut " * 2_000) for i in range(4)], "doc_id long, text string")
    model = lm.fit(df, F.lit(True), lm.head_of(lm.count(df, F.lit(True)), 100))
    class_of = lambda w: int(model.classes[list(model.keys).index(int(lm._batch_tokens(lm.pa.RecordBatch.from_arrays([lm.pa.array([w])], names=["text"]))[0][0]))])
    far, away, past, cut = map(class_of, ("far", "away", "past", "cut"))
    logp = lambda w: model.log_probability(np.array([w]), np.array([past]), np.array([cut]))[0]
    assert logp(cut) > max(logp(w) for w in (far, away, past))


# --- 9


def test_line_dedup(spark, docs, none, tmp_path):
    docs.write.parquet(str(tmp_path / "d"))
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOW)
    seen = Counter(k for _, t, *_ in ROWS for k in {key(x) for x in (t or "").split("\n")} if k)
    want = Counter()
    for d, t, *_ in ROWS:
        every = (t or "").split("\n")
        kept = [x for x in every if not key(x) or seen[key(x)] < 10]
        want[(d, len(every), len(every) - len(kept), "\n".join(kept))] += 1
    assert max(seen.values()) >= 10
    for table_ in (docs, spark.read.parquet(str(tmp_path / "d"))):
        for batches in (1, 7):
            got = linededup.clean(table_, batches=batches).select("doc_id", "n_lines", "n_dropped", "kept").collect()
            assert Counter(map(tuple, got)) == want
    assert linededup.clean(none).count() == 0


def test_line_runs_are_joined_and_compacted(spark):
    """A settled key is counted no further; runs become levels; merges and joins shuffle no run."""
    batch = lambda *lines: spark.createDataFrame([(x,) for x in lines], "line long")
    runs = linededup.LineRuns(spark, 3)
    runs.add(batch(1, 1, 1, 2, 3))
    with linededup._sorted_buckets(spark):
        counts = batch(1, 2, 4).groupBy("line").agg(F.count("*").alias("docs"))
        shape = lambda df: re.findall(r"Sort \[|Exchange |SortMergeJoin", df._jdf.queryExecution().executedPlan().toString())
        left = runs.unsettled(counts)
        assert shape(left).count("Exchange ") == 1 and "SortMergeJoin" in shape(left)
        assert sorted(r["line"] for r in left.collect()) == [2, 4]
        assert shape(runs._merged(runs.levels[0], runs.levels[0])) == ["SortMergeJoin"]
    for lines in ((1, 2, 4), (2, 5), (1, 5, 5)):
        runs.add(batch(*lines))
    assert [bool(x) for x in runs.levels] == [False, False, True]
    assert {r["line"]: r["docs"] for r in runs.runs[0].collect()} == {1: 3, 2: 3, 3: 1, 4: 1, 5: 3}
    assert sorted(r["line"] for r in runs.frequent().collect()) == [1, 2, 5]
    runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("gf_lines_")]


def test_a_text_of_many_frequent_lines(spark):
    texts = ["\n".join(f"line {i}" for i in range(3_000)) for _ in range(10)] + ["line 1\nown"]
    got = linededup.clean(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select("doc_id", "n_dropped", "kept").collect()
    assert {tuple(r) for r in got} == {*((i, 3_000, "") for i in range(10)), (10, 1, "own")}


# --- 10


@pytest.mark.parametrize("shards", [1, 5])
def test_sharding(docs, none, shards):
    got = sharding.assign(docs, shards).collect()
    assert len(got) == len(ROWS)
    assert Counter((g["doc_id"], g["size"], g["text_crc32"]) for g in got) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in ROWS)
    for s in range(shards):
        slots = sorted(g["slot"] for g in got if g["shard"] == s)
        assert slots == list(range(len(slots)))
    assert sharding.assign(none, shards).count() == 0


def test_shards_are_even_though_a_third_is_alike(spark, tmp_path):
    df = spark.range(3_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1_000, F.lit("x" * 99)).otherwise(F.repeat(F.lit("y"), F.pmod(F.xxhash64("id"), F.lit(200)).cast("int"))).alias("text"))
    sizes = [r["b"] for r in sharding.assign(df, 16).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 16 and max(sizes) < 1.05 * sum(sizes) / 16 and min(sizes) > 0.95 * sum(sizes) / 16
    sharding.write(df, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3_000
