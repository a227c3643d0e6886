"""Language-model scoring: a log-bilinear neural model trained by noise-contrastive estimation.

The model predicts the next token from the two before it. With vectors r for tokens as context and t for
tokens as targets, position weights c1 and c2, and biases b, a token w after u, v has the score
t[w]·(c1*r[v] + c2*r[u]) + b[w]. The score is a sum of one term for each context position, so the
normalising sum over all w factors into a product of two matrices, exp(T1 + b) and exp(T2): the log
normalisers of all pairs of contexts come from batched matrix products, once for all tasks, and a token's
normalised log probability is then one inner product and one gather.

The vocabulary grows with the corpus: the most frequent ``vocabulary_of`` (N) words, N**0.4 times a factor,
each with a target vector of its own, one class for the end and one for all other words. As contexts, the
``CONTEXTS`` most frequent words have vectors of their own and the rest of the vocabulary share one for each
quarter octave of their rank. A word outside the vocabulary has its class's probability times its share by
the smoothed counts of the whole training corpus, so every text's probability is a proper one, and rare and
unseen words cost what they are worth. Counts are over all training documents: per-batch counts are summed
by a shuffle. Words beyond the ``head`` most frequent are joined to their counts by a shuffle too; only the
head, whose size is fixed or that of the vocabulary, is sent to the workers.

Word identity is a 64-bit hash. The model learns from every token of every training row: in a round each
learner starts from the same weights and learns from its rows, and the learners' weights are averaged, by
tokens, over a shuffle. There are as many learners as keep what they send below about a tenth of the texts. There are
three rounds, each over at least as many rows as the one before: about ``sample_tokens`` tokens, a share ``FIRST`` or
so many tokens if that is more, and all. Tables of fewer tokens have all in each round, by the same rule.

Defined cases: a null or empty text is its end alone; a text of any length is read in slices; an empty
training set leaves N = 0, the base score log10(0.1 / 0.1) a token and a model that knows the end and one
unseen word; repeated rows and ties are scored alike; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridfold.llm import scratch
from gridfold.llm.tables import ROW, most_frequent, remainder, share, with_row
from gridfold.llm.textvec import U, mix, parts, utf8, words

#: The end's hash: that of no word, for words' hashes are of at least one byte.
END = int(mix(np.array([0xE4D], U)).view(np.int64)[0])
SMOOTH = 0.1
#: The model's width; tokens and noise tokens of a step in a task.
DIM, BATCH, NOISE = 32, 512, 64
#: The least share of training rows of the second round.
FIRST = 1 / 16
#: The vocabulary: at least so many words, and this factor of N**0.4. Contexts with vectors of their own.
LEAST_WORDS, GROWTH, CONTEXTS = 1_536, 4.0, 1_024
#: Learners of a round at least; what a learner may send, as a share of the bytes that it reads.
LEARNERS, SENT = 8, 0.1
#: Tokens that are scored at a time.
SCORED = 1 << 16


def vocabulary_of(tokens: int) -> int:
    return max(LEAST_WORDS, int(GROWTH * tokens**0.4))


def contexts_of(words: int, own: int = CONTEXTS) -> np.ndarray:
    """By target class (words by rank, the end, all others): its context class."""
    rank = np.arange(words)
    band = np.floor(4 * np.log2(np.maximum(rank, 1) / max(own, 1))).astype(np.int64)
    shared = np.where(rank < own, rank, min(own, words) + np.maximum(band, 0))
    last = int(shared.max()) + 1 if words else 0
    return np.append(shared, [last, last + 1])


@dataclass
class Counts:
    """The training corpus: N, V, and the head of its vocabulary sorted by hash."""

    tokens: int
    distinct: int
    keys: np.ndarray
    counts: np.ndarray


@dataclass
class Model:
    """Targets 0..n-1 are words, n is the end, n + 1 every other word; ``contexts`` are their context classes.

    first, second: the vectors of contexts at both positions; norm: the log normalisers of their pairs."""

    keys: np.ndarray
    classes: np.ndarray
    contexts: np.ndarray
    first: np.ndarray
    second: np.ndarray
    bias: np.ndarray
    target: np.ndarray
    norm: np.ndarray
    rest_log10: float

    def log_probability(self, w: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Natural logarithms of targets w after u after v."""
        out = np.empty(len(w))
        for at in range(0, len(w), SCORED):
            s = slice(at, at + SCORED)
            near, far = self.contexts[u[s]], self.contexts[v[s]]
            out[s] = np.einsum("ij,ij->i", self.first[near] + self.second[far], self.target[w[s]]) + self.bias[w[s]] - self.norm[near, far]
        return out


def normalisers(first: np.ndarray, second: np.ndarray, bias: np.ndarray, target: np.ndarray, block: int = 4_096) -> np.ndarray:
    """By both contexts: the logarithm of the sum over all targets of the exponential of their scores."""
    first, second, bias, target = (x.astype(np.float64) for x in (first, second, bias, target))
    parts = [slice(at, at + block) for at in range(0, len(target), block)]
    top, low = np.full(len(first), -np.inf), np.full(len(second), -np.inf)
    for s in parts:
        top, low = np.maximum(top, (first @ target[s].T + bias[s]).max(1)), np.maximum(low, (second @ target[s].T).max(1))
    total = np.zeros((len(first), len(second)))
    for s in parts:
        total += np.exp(first @ target[s].T + bias[s] - top[:, None]) @ np.exp(second @ target[s].T - low[:, None]).T
    return np.log(total) + top[:, None] + low


def _batch_tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes of all words and of each text's end, in order; the row of each; rows."""
    data, bounds = utf8(batch.column("text"))
    n = len(bounds) - 1
    found = list(words(data, bounds))
    keys = np.concatenate([k for k, _ in found]) if found else np.zeros(0, U)
    rows = np.concatenate([r for _, r in found]) if found else np.zeros(0, np.int64)
    per = np.bincount(rows, minlength=n)
    stops = np.cumsum(per)
    return np.insert(keys.view(np.int64), stops, END), np.insert(rows, stops, np.arange(n)), n


def count(docs: DataFrame, training: Column) -> DataFrame:
    """token (hash), n: how often each token stands in the training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, back = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(back, np.concatenate([c for _, c in held])).astype(np.int64)

        for part, _, _ in parts(batches):
            keys, _, _ = _batch_tokens(part)
            held.append(np.unique(keys, return_counts=True))
            if sum(len(k) for k, _ in held) > 2_000_000:
                held[:] = [merged()]
                if len(held[0][0]) > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop()], names=["token", "n"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], names=["token", "n"])

    counted = docs.where(training).select("text").mapInArrow(run, "token long, n long")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


def head_of(counts: DataFrame, head: int) -> Counts:
    """The head, which always has the end if any text ends."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = most_frequent(counts, "n", head).unionByName(counts.where(F.col("token") == END)).dropDuplicates(["token"]).toPandas()
    keys, n = top["token"].to_numpy(np.int64), top["n"].to_numpy(np.int64)
    order = np.argsort(keys)
    return Counts(int(total["n"]), int(total["v"]), keys[order], n[order])


class Trainer:
    """Noise-contrastive estimation with unigram noise and Adagrad. contexts: by target its context class."""

    def __init__(self, class_counts: np.ndarray, contexts: np.ndarray | None = None, dim: int = DIM, noise: int = 128, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        size = len(class_counts)
        self.contexts = np.arange(size) if contexts is None else contexts
        unigram = (class_counts + SMOOTH) / (class_counts + SMOOTH).sum()
        self.end, self.noise, self.rate = size - 2, noise, 0.1
        self.log_noise = np.log(noise * unigram).astype(np.float32)
        self.ladder = np.cumsum(unigram)
        R = (rng.standard_normal((int(self.contexts.max()) + 1, dim)) * 0.1).astype(np.float32)
        T = (rng.standard_normal((size, dim)) * 0.1).astype(np.float32)
        C = np.array([[1.0] * dim, [0.5] * dim], np.float32)
        self.values = [R, T, C, np.log(unigram).astype(np.float32)]
        self.sums = [np.full_like(x, 1e-3) for x in self.values]

    def _step(self, which: int, where: np.ndarray, grad: np.ndarray) -> None:
        x, acc = self.values[which], self.sums[which]
        order = np.argsort(where, kind="stable")
        rows, first = np.unique(where[order], return_index=True)
        total = np.add.reduceat(grad[order], first, axis=0)
        acc[rows] += total**2
        x[rows] -= self.rate * total / np.sqrt(acc[rows])

    def learn(self, w: np.ndarray, u: np.ndarray, v: np.ndarray, rng: np.random.Generator) -> None:
        """One step: targets w after contexts u after v."""
        R, T, C, B = self.values
        k = np.minimum(np.searchsorted(self.ladder, rng.random(self.noise)), len(B) - 1)
        q = C[0] * R[u] + C[1] * R[v]
        good = (q * T[w]).sum(1) + B[w] - self.log_noise[w]
        bad = q @ T[k].T + B[k] - self.log_noise[k]
        # Each noise token stands for one draw of each position in the batch.
        dg = -1 / (1 + np.exp(np.clip(good, -30, 30)))
        db = 1 / (1 + np.exp(-np.clip(bad, -30, 30)))
        n = np.float32(len(w))
        dg, db = dg / n, db / n
        dq = dg[:, None] * T[w] + db @ T[k]
        gt_w, gt_k = dg[:, None] * q, db.T @ q
        dc = np.stack([(dq * R[u]).sum(0), (dq * R[v]).sum(0)])
        self._step(1, np.concatenate([w, k]), np.concatenate([gt_w, gt_k]))
        self._step(3, np.concatenate([w, k]), np.concatenate([dg, db.sum(0)]).astype(np.float32))
        self._step(0, np.concatenate([u, v]), np.concatenate([dq * C[0], dq * C[1]]))
        self.sums[2] += dc**2
        C -= 0.1 * self.rate * dc / np.sqrt(self.sums[2])

    def learn_text(self, ids: np.ndarray, fresh: np.ndarray, batch: int, rng: np.random.Generator, mixed: bool = False) -> None:
        """All of a running text, batch by batch; ``mixed``: a batch's tokens are from all over it."""
        u, v = previous(ids, fresh, self.end)
        u, v = self.contexts[u], self.contexts[v]
        if mixed:
            order = rng.permutation(len(ids))
            ids, u, v = ids[order], u[order], v[order]
        for at in rng.permutation(-(-len(ids) // batch)):
            s = slice(at * batch, (at + 1) * batch)
            self.learn(ids[s], u[s], v[s], rng)

    def rows(self) -> list[bytes]:
        """The whole state: of each context, of each target, and the position weights."""
        R, T, C, B = self.values
        r, t, c, b = self.sums
        rows = [np.concatenate([R, r], 1), np.concatenate([T, t, B[:, None], b[:, None]], 1), np.concatenate([C, c], 1).reshape(1, -1)]
        return [x.astype(np.float32).tobytes() for part in rows for x in part]

    def set_rows(self, rows: list[bytes]) -> None:
        n, dim = self.values[0].shape
        table = lambda part: np.stack([np.frombuffer(x, np.float32) for x in part])
        R, T, C = table(rows[:n]), table(rows[n:-1]), table(rows[-1:]).reshape(2, -1)
        self.values = [R[:, :dim].copy(), T[:, :dim].copy(), C[:, :dim].copy(), T[:, 2 * dim].copy()]
        self.sums = [R[:, dim:].copy(), T[:, dim : 2 * dim].copy(), C[:, dim:].copy(), T[:, 2 * dim + 1].copy()]

    def result(self) -> tuple[np.ndarray, ...]:
        R, T, C, B = self.values
        return R * C[0], R * C[1], B, T


def previous(ids: np.ndarray, fresh: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The token before each and the one before that; before a text stands the end. fresh: a text begins."""
    u = np.empty_like(ids)
    u[:1], u[1:] = end, ids[:-1]
    u[fresh] = end
    v = np.empty_like(ids)
    v[:1], v[1:] = end, u[:-1]
    v[fresh] = end
    return u, v


def train(ids: np.ndarray, fresh: np.ndarray, class_counts: np.ndarray, dim: int = DIM, noise: int = 128, batch: int = 256, epochs: int = 3, seed: int = 7) -> tuple[np.ndarray, ...]:
    """first, second, bias, target from one running text.

    ids: its classes; fresh: whether a text begins there."""
    trainer, rng = Trainer(class_counts, None, dim, noise, seed), np.random.default_rng(seed)
    for _ in range(epochs):
        if len(ids):
            trainer.learn_text(ids, fresh, batch, rng)
    return trainer.result()


def classes_of(tokens: np.ndarray, keys: np.ndarray, classes: np.ndarray, other: int) -> np.ndarray:
    if not len(keys):
        return np.full(len(tokens), other)
    at = np.minimum(np.searchsorted(keys, tokens), len(keys) - 1)
    return np.where(keys[at] == tokens, classes[at], other)


def learn_round(docs: DataFrame, keys: np.ndarray, classes: np.ndarray, contexts: np.ndarray, class_counts: np.ndarray, state: list[bytes], turn: int) -> tuple[list[bytes], int]:
    """The average of the learners' states after one pass over all texts, and how many tokens that were."""
    shared = docs.sparkSession.sparkContext.broadcast((keys, classes, contexts, class_counts, state))  # of the vocabulary's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        keys, classes, contexts, class_counts, state = shared.value
        task = TaskContext.get().partitionId()
        trainer, rng, seen = Trainer(class_counts, contexts, noise=NOISE), np.random.default_rng((turn, task)), 0
        trainer.set_rows(state)
        for part, _, _ in parts(batches):
            tokens, row, _ = _batch_tokens(part)
            fresh = np.ones(len(row), bool)
            fresh[1:] = row[1:] != row[:-1]
            trainer.learn_text(classes_of(tokens, keys, classes, len(class_counts) - 1), fresh, BATCH, rng, mixed=True)
            seen += len(tokens)
        if seen:
            out = trainer.rows()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out))), pa.array(np.full(len(out), task)), pa.array(np.full(len(out), seen)), pa.array(out, pa.binary())], names=["class", "task", "n", "state"])

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        tokens: dict[int, int] = {}
        for batch in batches:
            for c, n, x in zip(*(batch.column(name).to_pylist() for name in ("class", "n", "state")), strict=True):
                total[c] = total.get(c, 0) + n * np.frombuffer(x, np.float32).astype(np.float64)
                tokens[c] = tokens.get(c, 0) + n
        rows = [pa.array(list(total), pa.int64()), pa.array(list(tokens.values()), pa.int64()), pa.array([(x / tokens[c]).astype(np.float32).tobytes() for c, x in total.items()], pa.binary())]
        yield pa.RecordBatch.from_arrays(rows, names=["class", "n", "state"])

    learnt = docs.select("text").mapInArrow(run, "class long, task long, n long, state binary")
    found = learnt.repartition("class").sortWithinPartitions("class", "task").mapInArrow(average, "class long, n long, state binary").collect()  # of the vocabulary's size
    if not found:
        return state, 0
    return [bytes(x["state"]) for x in sorted(found, key=lambda x: x["class"])], found[0]["n"]


def learners(tokens: int, state: list[bytes]) -> int:
    """How many may learn side by side; a word is taken for six bytes of text."""
    return max(LEARNERS, int(SENT * 6 * tokens / sum(map(len, state))))


def fit(docs: DataFrame, training: Column, counts: Counts, vocabulary: int | None = None, sample_tokens: int = 600_000) -> Model:
    """Train on all training rows, in rounds."""
    by_count = np.lexsort((counts.keys, -counts.counts))
    by_count = by_count[counts.keys[by_count] != END][: vocabulary_of(counts.tokens) if vocabulary is None else vocabulary]
    keys = np.append(counts.keys[by_count], END)
    n = len(by_count)
    ends = counts.counts[counts.keys == END].sum()
    per_class = np.append(counts.counts[by_count], ends).astype(np.float64)
    # All other words' smoothed mass; one added type stands for every unseen word.
    rest_mass = counts.tokens - per_class.sum() + SMOOTH * (counts.distinct - n - bool(ends) + 1)
    order = np.argsort(keys)
    classes, contexts = np.arange(n + 1), contexts_of(n)
    class_counts = np.append(per_class, rest_mass)
    trainer = Trainer(class_counts, contexts)
    rows = docs.where(training)
    few = sample_tokens / max(1, counts.tokens)
    for turn, part in enumerate((few, max(FIRST, few), 1)):
        state = trainer.rows()
        some = rows.where(share(part, F.lit("lm"), "doc_id", "text"))
        state, _ = learn_round(some.coalesce(learners(counts.tokens, state)), keys[order], classes[order], contexts, class_counts, state, turn)
        trainer.set_rows(state)
    first, second, bias, target = trainer.result()
    norm = normalisers(first, second, bias, target).astype(np.float32)
    return Model(keys[order], classes[order], contexts, first, second, bias, target, norm, float(np.log10(rest_mass)))


def score(docs: DataFrame, training: Column | None = None, head: int = 1 << 17, vocabulary: int | None = None, sample_tokens: int = 600_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    training = remainder(F.col("doc_id"), 10) != 0 if training is None else training
    docs = docs.select("doc_id", "text")
    rows = with_row(docs).select(ROW, F.col("doc_id").cast("long").alias("doc_id"), (~training).alias("held_out"), "text")
    counts = scratch.cut(count(docs, training), "lm-counts")
    if vocabulary is None:
        vocabulary = vocabulary_of(counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    known = head_of(counts, max(head, vocabulary))
    model = fit(docs, training, known, vocabulary, sample_tokens)
    shared = spark.sparkContext.broadcast((known, model))  # of the head's and the vocabulary's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model = shared.value
        other = len(model.classes)
        end = other - 1
        for part, _, _ in parts(batches):
            tokens, row, n = _batch_tokens(part)
            at = np.minimum(np.searchsorted(known.keys, tokens), max(0, len(known.keys) - 1))
            in_head = known.keys[at] == tokens if len(known.keys) else np.zeros(len(tokens), bool)
            worth = np.zeros(len(tokens))
            worth[in_head] = np.log10(known.counts[at[in_head]] + SMOOTH)
            w = classes_of(tokens, model.keys, model.classes, other)
            fresh = np.ones(len(row), bool)
            fresh[1:] = row[1:] != row[:-1]
            u, v = previous(w, fresh, end)
            logp = model.log_probability(w, u, v) / np.log(10)
            rare = w == other
            logp[rare] += worth[rare] - model.rest_log10
            add = lambda x, row=row, n=n: np.bincount(row, x, minlength=n)
            # The tail: words beyond the head, once for each text, to be joined to their counts.
            tail = np.flatnonzero(~in_head)
            order = np.lexsort((tokens[tail], row[tail]))
            t_row, t_key = row[tail][order], tokens[tail][order]
            begin = np.flatnonzero(np.concatenate([[True], (np.diff(t_row) != 0) | (np.diff(t_key) != 0)])) if len(tail) else np.zeros(0, np.int64)
            times = np.diff(np.append(begin, len(t_row)))
            bounds = np.concatenate([[0], np.cumsum(np.bincount(t_row[begin], minlength=n))]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x)) for x in (t_key[begin], times.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(
                [part.column(ROW), part.column("doc_id"), part.column("held_out"), pa.array(add(np.ones(len(row))).astype(np.int64)), pa.array(add(in_head).astype(np.int64)), pa.array(add(worth)), pa.array(add(logp)), *lists],
                names=[ROW, "doc_id", "held_out", "n_tokens", "head_tokens", "head_worth", "head_logp", "tail", "times"],
            )

    schema = f"{ROW} string, doc_id long, held_out boolean, n_tokens long, head_tokens long, head_worth double, head_logp double, tail array<long>, times array<int>"
    scored = scratch.cut(rows.mapInArrow(run, schema), "lm-scored")
    tail = scored.select(ROW, F.explode(F.arrays_zip("tail", "times")).alias("x")).select(ROW, F.col("x.tail").alias("token"), F.col("x.times").alias("times"))
    found = (
        tail.join(counts, "token", "left")
        .groupBy(ROW)
        .agg(
            F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("tail_known"),
            F.sum(F.col("times") * F.log10(F.coalesce(F.col("n"), F.lit(0)) + SMOOTH)).alias("tail_worth"),
            F.sum("times").alias("tail_tokens"),
        )
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    denominator = float(np.log10(known.tokens + SMOOTH * (known.distinct + 1)))
    return scored.join(found, ROW, "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_tokens") + zero("tail_known")).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("head_worth") + zero("tail_worth") - F.col("n_tokens") * denominator).alias("base_score"),
        # The tail's words are all of the last class, whose share by smoothed counts was left open.
        (F.col("head_logp") + zero("tail_worth")).alias("score"),
    )
