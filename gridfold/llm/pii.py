"""Personal data in texts: candidate spans, gradient-boosted trees over them, calibrated thresholds.

For each kind (email, ip, card, phone) a strict generator proposes the base spans: leftmost,
non-overlapping matches of a fixed pattern that pass a fixed test; these always stay. A loose generator
proposes further spans of other spellings (``name (at) host dot org``, IPv6, card numbers with dots,
national phone numbers); these overlap each other and the base spans. Boosted trees over format and
context features score them; a candidate is redacted as well if its score reaches its kind's threshold,
it touches no base span, and no better candidate overlaps it. Loose spellings are bounded by their patterns: up to
six labels of a spelt-out host, eight groups of an IPv6 address, two marks between digits and five groups of
a national number; of a longer one a part is proposed, or nothing. Base spans have no such bounds.

The trees are trained on the driver on ``TRAINING`` generated, labelled examples (a bounded, fixed
sample); half of them are held out to calibrate the thresholds for precision. Scoring is one SQL
expression: texts never leave the JVM, and nothing is shuffled.

Positions are code points, the end exclusive. Patterns use possessive repeats and anchors, so that long
runs of one character class cost linear time. Spans of one kind don't overlap, so they are sorted at both
ends: what a candidate touches is found by binary search, and contexts come from the pieces between
matches. A text takes time in proportion to its length and, but for a logarithm, to its spans.

Defined cases: a null or empty text has no spans; a text of any length and with any number of spans is
searched whole; of overlapping candidates of equal score the one that begins first is better, then the
kind first by name; repeated rows and null ids are rows like others; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import random
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridfold.llm import boosting
from gridfold.llm.arrays import count_while, let, running_max, running_sums, steps

KINDS = ("email", "ip", "card", "phone")
#: The strict patterns. A match begins where a run of its first characters does, or right behind another.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9](?:[\x20().-]*+[0-9])++",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\x20?[(\[{]at[)\]}]\x20?|\x20at\x20|\x20?@\x20?)[A-Za-z0-9-]++(?:(?:\x20?[(\[{]dot[)\]}]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]++){1,6}+",
    "ip": r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4}){1,7}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[\x20./_-]{0,2}[0-9]){12,18}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z.,:/+-])(?:\+|\()?[0-9]{1,4}(?:[\x20./()-]{1,2}[0-9]{2,5}){1,4}(?![0-9A-Za-z.,:/-])",
}
#: The greatest part of an address, and how many digits cards and phones have.
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})\.){3}0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})$"
CARD, PHONE = (13, 19), (9, 15)
SPANS = "array<struct<start:int,end:int,m:string>>"
#: Words of the context, as patterns over its lower-cased form.
HINTS = {
    "hint_email": r"mail|contact|write|kontakt|correo|courriel",
    "hint_ip": r"\bip\b|ipv6|host|server|address|adresse",
    "hint_card": r"card|visa|master|amex|credit|karte|tarjeta|carte",
    "hint_phone": r"tel|phone|call|mobile|fax|\bfon\b|rufnummer|appel|llam",
    "hint_other": r"token|isbn|order|invoice|version|\bref\b|serial|\bid\b|score|total|date|\bart\b|build",
}
FEATURES = [*(f"is_{k}" for k in KINDS), "digits", "chars", "letters", "seps", "plus", "paren", "luhn", "at_sign", "colons", "groups", "longest", "glued_left", "glued_right", *HINTS]
TRAINING = 2_400
CONTEXT = 24
#: The pieces of a text that its last CONTEXT characters before a match are in: no match is shorter than 5.
PIECES = 5
#: Characters that a text is cut into for looking up spans.
CHUNK = 4_096


def matches(text: Column, pattern: str, near: bool = False) -> Column:
    """Leftmost non-overlapping matches with their bounds: what splitting leaves gives the positions.

    near: also what stands before each (``left``, CONTEXT characters) and behind it (``right``, one)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(m: Column) -> Column:
        def with_parts(part: Column) -> Column:
            ends = running_sums(F.transform(m, lambda x, i: F.length(F.get(part, i)) + F.length(x)))
            span = lambda e, i: [(e - F.length(F.get(m, i))).alias("start"), e.alias("end"), F.get(m, i).alias("m")]
            if not near:
                return let(ends, lambda end: F.transform(end, lambda e, i: F.struct(*span(e, i))))

            def with_tails(tail: Column) -> Column:
                pieces = lambda i: [F.coalesce(x, F.lit("")) for j in range(PIECES, 0, -1) for x in (F.get(tail, i - j), F.get(m, i - j))]
                left = lambda i: F.right(F.concat(*pieces(i), F.get(tail, i)), F.lit(CONTEXT)).alias("left")
                behind = lambda i: F.when(F.get(part, i + 1) != "", F.left(F.get(part, i + 1), F.lit(1))).otherwise(F.left(F.coalesce(F.get(m, i + 1), F.lit("")), F.lit(1))).alias("right")
                return let(ends, lambda end: F.transform(end, lambda e, i: F.struct(*span(e, i), left(i), behind(i))))

            return let(F.transform(part, lambda x: F.right(x, F.lit(CONTEXT))), with_tails)

        return let(F.split(text, pattern, -1), with_parts)

    some = let(found, lambda m: F.when(F.size(m) > 0, placed(m)))
    return F.coalesce(some, F.array().cast(SPANS.replace("m:string", "m:string,left:string,right:string") if near else SPANS))


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes Luhn's test."""

    def worth(i: Column) -> Column:
        d = F.substring(number, F.length(number) - i, 1).cast("int")
        return F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    places = F.sequence(F.lit(0), F.greatest(F.length(number), F.lit(1)) - 1)
    return (F.length(number) > 0) & (F.aggregate(places, F.lit(0), lambda acc, i: acc + worth(i)) % 10 == 0)


def passes(kind: str, m: Column) -> Column:
    n = F.length(digits(m))
    if kind == "ip":
        return m.rlike(OCTETS)
    if kind == "card":
        return n.between(*CARD) & luhn(digits(m))
    return n.between(*PHONE) if kind == "phone" else F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    return F.filter(matches(text, STRICT[kind]), lambda x: passes(kind, x["m"]))


def features(kind: Column, m: Column, left: Column, right: Column) -> list[Column]:
    """The features of a candidate between its contexts, as doubles."""
    number = digits(m)
    count = lambda pattern: F.length(F.regexp_replace(m, pattern, ""))
    groups = F.split(F.trim(F.regexp_replace(m, "[^0-9A-Za-z]+", " ")), " ")
    near = F.lower(left)
    out = [(kind == k).alias(f"is_{k}") for k in KINDS]
    out += [
        F.length(number).alias("digits"),
        F.length(m).alias("chars"),
        count("[^A-Za-z]").alias("letters"),
        count("[0-9A-Za-z]").alias("seps"),
        F.substring(m, 1, 1).isin("+").alias("plus"),
        m.contains("(").alias("paren"),
        (F.length(number).between(*CARD) & luhn(number)).alias("luhn"),
        m.contains("@").alias("at_sign"),
        count("[^:]").alias("colons"),
        F.size(groups).alias("groups"),
        F.array_max(F.transform(groups, F.length)).alias("longest"),
        left.rlike(r"[0-9A-Za-z_#=\"'$]$").alias("glued_left"),
        right.rlike(r"^[0-9A-Za-z_%\"']").alias("glued_right"),
    ]
    out += [near.rlike(p).alias(name) for name, p in HINTS.items()]
    return [c.cast("double").alias(name) for c, name in zip(out, FEATURES, strict=True)]


def _number(r: random.Random, n: int, valid: bool) -> str:
    body = [r.randrange(10) for _ in range(n - 1)]
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(body)))
    check = -total % 10
    return "".join(map(str, body)) + str(check if valid else (check + r.randrange(1, 10)) % 10)


def examples(n: int = TRAINING, seed: int = 17) -> list[tuple[str, str, str, str, int]]:
    """kind, span, left context, right context, label: generated spellings of the kinds and lookalikes."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("aeioulnrstdm") for _ in range(r.randint(2, 8)))
    num = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    hexa = lambda k: "".join(r.choice("0123456789abcdef") for _ in range(k))
    good = {"email": "mail contact e-mail write Kontakt", "ip": "ip host server address", "card": "card visa credit Karte tarjeta", "phone": "tel phone call mobile fax appel"}
    other = "token isbn order invoice version ref serial id score total date art build".split()
    out = []
    for i in range(n):
        kind, label = KINDS[i % 4], i // 4 % 2
        if kind == "email":
            at, dot = r.choice([(" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", " dot "), ("(at)", "."), (" @ ", ".")])
            top = r.choice(["com", "org", "net", "de", "io"])
            span = f"{word()}.{word()}{at}{word()}{dot}{top}" if label else f"{word()} at {word()}.{word()}"
        elif kind == "ip":
            span = ":".join(hexa(4) for _ in range(8)) if r.random() < 0.7 else f"{hexa(4)}::{hexa(4)}:{hexa(4)}:{hexa(2)}"
            span = span if label else r.choice([f"{num(2)}:{num(2)}:{num(2)}", f"{num(1)}:{num(2)}:{num(2)}:{num(2)}", f"{num(4)}:{num(2)}:{num(2)}"])
        elif kind == "card":
            k = r.choice([13, 15, 16, 16, 16, 19])
            digits_ = _number(r, k, bool(label) or r.random() < 0.1)
            sep = r.choice([".", "/", "_", "  ", " - "]) if label or r.random() < 0.6 else ""
            span = sep.join(digits_[j : j + 4] for j in range(0, k, 4))
        else:
            span = r.choice([f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}-{num(3)}-{num(4)}", f"0{num(3)} {num(3)} {num(4)}", f"{num(3)} {num(3)} {num(4)}", f"0{num(2)}/{num(7)}"])
            if not label:
                span = r.choice([f"20{num(2)}-{num(2)}-{num(2)}", f"{num(2)} {num(3)} {num(3)}", f"{num(2)}-{num(2)}", f"978-{num(1)}-{num(4)}-{num(4)}", f"{num(4)} {num(4)}", f"{num(3)} {num(3)}", f"{num(2)}.{num(2)}.{num(4)}", f"{num(1)} {num(2)} {num(3)}"])
        # A spelling that is a phone's as well as a mere number's needs its context.
        hint = r.random() < (0.75 if kind == "phone" else 0.4) if label else r.random() < 0.1
        near = r.choice(good[kind].split()) + r.choice([": ", " ", ": "]) if hint else r.choice(other) + " " if not label and r.random() < 0.6 else ""
        glue = r.choice(["=", '"', "#", "$", "_"]) if not label and r.random() < 0.25 else ""
        right = r.choice(['"', "%", "x"]) if not label and r.random() < 0.2 else r.choice([" ", ".", ",", "\n", ""])
        out.append((kind, span, f"{word()} {word()} {near}{glue}"[-CONTEXT:], f"{right}{word()}", label))
    return out


@cache
def _learn(rows: tuple) -> tuple[str, dict[str, float]]:
    x = np.array([r[:-1] for r in rows], float)
    y = np.array([r[-1] for r in rows], float)
    held = np.arange(len(y)) // 8 % 2 == 1
    trees = boosting.fit(x[~held], y[~held])
    score = boosting.margin(trees, x)
    limits = {k: boosting.threshold(score[held & (x[:, i] == 1)], y[held & (x[:, i] == 1)], 0.99) for i, k in enumerate(KINDS)}
    return " + ".join(boosting.sql(t, [f"c.f.{f}" for f in FEATURES]) for t in trees), limits


def model(spark: SparkSession) -> tuple[str, dict[str, float]]:
    """The trees as a SQL expression over c.f.<feature>, and the kinds' thresholds."""
    rows = spark.createDataFrame(examples(), "kind string, m string, near string, after string, label int")
    got = rows.select(*features(F.col("kind"), F.col("m"), F.col("near"), F.col("after")), "label").collect()
    return _learn(tuple(map(tuple, got)))


def _named(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(kind).alias("kind")))


def _spelled(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda x: F.concat(F.lit(f"{kind}:"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string")))


def touching(spans: Column, by: Column, x: Column) -> Column:
    """Those of sorted spans without overlaps that a span overlaps. by: ``steps`` of the spans."""
    first = count_while(spans, by, lambda o: o["end"] <= x["start"])
    return let(first, lambda low: F.slice(spans, low + 1, F.greatest(count_while(spans, by, lambda o: o["start"] < x["end"]) - low, F.lit(0))))


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, text, base (spans by kind) and added (spans by kind) of each row, as arrays by kind."""
    spark = docs.sparkSession
    scored, limits = model(spark)
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = whole.select("*", *[base_spans(F.col("text"), k).alias(f"base_{k}") for k in KINDS], *[matches(F.col("text"), LOOSE[k], near=True).alias(f"loose_{k}") for k in KINDS])
    searched = found.select("*", *[steps(F.col(f"base_{k}")).alias(f"by_{k}") for k in KINDS])

    def judged(kind: str) -> Column:
        """The candidates of a kind that touch no base span and reach the threshold."""
        if not np.isfinite(limits[kind]):
            return F.array().cast("array<struct<start:int,end:int,over:double>>")

        clear = lambda c: ~F.greatest(*[F.size(touching(F.col(f"base_{k}"), F.col(f"by_{k}"), c)) > 0 for k in KINDS])
        described = lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), F.struct(*features(F.lit(kind), c["m"], c["left"], c["right"])).alias("f"))
        return F.transform(F.filter(f"loose_{kind}", clear), described)

    described = searched.select("doc_id", "text", *[f"base_{k}" for k in KINDS], *[judged(k).alias(f"cand_{k}") for k in KINDS])
    limit = lambda k: f"filter(transform(cand_{k}, c -> named_struct('start', c.start, 'end', c.end, 'over', ({scored}) - {limits[k]!r}D)), c -> c.over >= 0)"
    good = described.select("doc_id", "text", *[f"base_{k}" for k in KINDS], *[(F.expr(limit(k)) if np.isfinite(limits[k]) else F.col(f"cand_{k}")).alias(f"good_{k}") for k in KINDS])
    good = good.select("*", *[steps(F.col(f"good_{k}")).alias(f"by_{k}") for k in KINDS])

    def best(kind: str) -> Column:
        """Those that no better candidate of another kind overlaps; of one kind none do."""

        def beaten(c: Column, other: str) -> Column:
            first = lambda o: (o["start"] < c["start"]) | ((o["start"] == c["start"]) & F.lit(other < kind))
            better = lambda o: (o["over"] > c["over"]) | ((o["over"] == c["over"]) & first(o))
            return F.exists(touching(F.col(f"good_{other}"), F.col(f"by_{other}"), c), better)

        stays = lambda c: ~F.greatest(*[beaten(c, k) for k in KINDS if k != kind])
        return F.transform(F.filter(f"good_{kind}", stays), bare)

    bare = lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))
    return good.select("doc_id", "text", *[F.transform(f"base_{k}", bare).alias(f"base_{k}") for k in KINDS], *[best(k).alias(f"added_{k}") for k in KINDS])


def listed(prefixes: tuple[str, ...]) -> Column:
    """kind:start:end of spans by kind, then by start, joined by commas."""
    parts = []
    for k in KINDS:
        every = F.array_sort(F.concat(*[F.col(f"{p}_{k}") for p in prefixes]))
        parts.append(_spelled(every, k))
    return F.array_join(F.concat(*parts), ",")


def redact(docs: DataFrame) -> DataFrame:
    """doc_id, text with each span replaced by its kind in brackets; overlapping ones by the first's."""
    found = detect(docs)
    tagged = F.array_sort(F.concat(*[_named(F.concat(f"base_{k}", f"added_{k}"), k) for k in KINDS]))
    chunks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))

    def between(chunk: Column, low: Column, high: Column) -> Column:
        """The text from one position to another, from the chunks that hold it."""
        first, last = F.floor(low / CHUNK).cast("int"), F.floor(F.greatest(high - 1, low) / CHUNK).cast("int")
        cut = lambda c, i: F.substring(c, F.greatest(low - (first + i) * CHUNK, F.lit(0)) + 1, F.greatest(high - F.greatest(low, (first + i) * CHUNK), F.lit(0)))
        return F.array_join(F.transform(F.slice(chunk, first + 1, last - first + 1), cut), "")

    def pieces(chunk: Column, spans: Column, reach: Column) -> Column:
        # reach: how far the spans up to each one go. A span that begins within what is gone adds no name.
        before = lambda i: F.when(i == 0, 0).otherwise(F.get(reach, i - 1))
        named = lambda x, i: F.when(x["start"] >= before(i), F.concat(between(chunk, before(i), x["start"]), F.lit("["), x["kind"], F.lit("]"))).otherwise("")
        end = F.coalesce(F.get(reach, F.size(spans) - 1), F.lit(0))
        return F.concat(F.array_join(F.transform(spans, named), ""), let(end, lambda e: between(chunk, e, F.length("text"))))

    whole = let(chunks, lambda c: let(tagged, lambda x: let(running_max(F.transform(x, lambda s: s["end"])), lambda r: pieces(c, x, r))))
    return found.select("doc_id", F.when(F.length("text") > 0, whole).otherwise("").alias("text"))


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        *[F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(("base",)).cast("binary"), 256).alias("base_sha256"),
        listed(("base", "added")).alias("spans"),
        sum((F.size(f"{p}_{k}") for p in ("base", "added") for k in KINDS), F.lit(0)).cast("long").alias("n_spans"),
    )
