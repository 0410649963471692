"""Language-model scores: a gated recurrent unit with a class-factored softmax, in numpy inside tasks.

Tokens are the words of a text, A-Z lower-cased, and one end.  Spark counts
every token of the corpus; the counts stay a table.  Of them only the ``TOP``
most frequent go to the tasks (about 1 MB): the first ``CLASSES * PER_CLASS``
form frequency classes of the softmax, the others one class; all further words
form the class "rare", whose tokens leave the scan and are joined to the count
table.  P(word) = P(class | state) * P(word | class, state), where the last
factor is a softmax for a frequency class and the smoothed share of the counts
for the last two classes, so the model is a proper distribution over all words.

The network starts as the smoothed unigram model and is trained by truncated
backpropagation (Adam) on every training text, inside the tasks.  The texts are
dealt over ``ROUNDS`` by hash; in each round a task trains on its partition's
texts from the weights of the round before, and the tasks' weights, a written
table, are averaged by their tokens.  Only the averages, of fixed size, come to
the driver.  Which texts share a task follows the partitions of the input, and
so do the weights.  Scoring runs the documents of a batch in lockstep, in windows
of ``STEPS`` tokens; the state is carried from window to window, so that whole
texts of any length are scored in bounded memory.

Null texts are empty and have the end as their only token; a null id counts as
training; repeated rows score alike; with nothing to train on, all counts are 0.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.words import words
from ledgerlight.plans.lineage import materialize

TOP, CLASSES, PER_CLASS, HIDDEN = 65_536, 24, 24, 16
MID, RARE = CLASSES, CLASSES + 1               # numbers of the last two classes
VOCABULARY = CLASSES * PER_CLASS               # ids 0 (the end) to VOCABULARY - 1, then MID, then RARE
#: Rounds that the training texts are dealt over, and tokens that a task trains on at a time (its memory, not a bound).
ROUNDS, SLAB = 5, 1_000_000
#: Sub-streams of a slab, at every size; tokens of each in an update; Adam's rate in the first round.
LANES, STEPS, RATE = 64, 24, 0.03
#: Weights are averaged as whole multiples of 1 / UNIT, so that no order of the tasks shows.
UNIT = 1 << 20
LOCKSTEP = 1024
#: Class of each id, and its place in a frequency class; of few bits, which sort fast.
CLASS_OF = np.append(np.arange(VOCABULARY) // PER_CLASS, [MID, RARE]).astype(np.uint8)
WORD_OF = np.append(np.arange(VOCABULARY) % PER_CLASS, [0, 0])
END = np.uint64(0x2545F4914F6CDD1D)


@dataclass
class Net:
    x: np.ndarray          # input of each id, to the three gates
    u: np.ndarray          # state to the gates
    c: np.ndarray          # state to the classes
    cb: np.ndarray
    w: np.ndarray          # state to the words of each class
    wb: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.x, self.u, self.c, self.cb, self.w, self.wb]


@dataclass
class Counts:
    """What the tasks need of the count table."""

    tokens: np.ndarray     # sorted hashes of the TOP tokens
    ids: np.ndarray        # id of each
    count: np.ndarray      # training count of each
    total: int             # N
    distinct: int          # V
    mid: tuple[float, int]
    rare: tuple[float, int]
    by_id: np.ndarray = field(default_factory=lambda: np.zeros(VOCABULARY))

    def parts(self) -> list:
        return [self.tokens, self.ids, self.count, self.total, self.distinct, self.mid, self.rare, self.by_id]


def _token_counts(batches):
    for batch in batches:
        train = batch.column(1).to_numpy(zero_copy_only=False)
        parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for w in words(batch.column(0)):
            token, at = np.unique(w.hash, return_inverse=True)
            c = np.bincount(at, train[w.row], minlength=len(token)).astype(np.int64)
            parts.append((token, c, np.bincount(at, minlength=len(token))))
        parts.append((np.array([END]), np.array([train.sum()], np.int64), np.array([len(train)])))
        token, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        sums = [np.bincount(at, np.concatenate([p[k] for p in parts]), minlength=len(token)).astype(np.int64) for k in (1, 2)]
        yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), *map(pa.array, sums)], ["token", "c", "n"])


def count_tokens(documents: DataFrame, in_training: Column) -> DataFrame:
    """(token, c, n): each token's hash with its count in training and in all documents."""
    rows = documents.select("text", in_training.alias("train"))
    sums = rows.mapInArrow(_token_counts, "token long, c long, n long")
    return materialize(sums.groupBy("token").agg(F.sum("c").alias("c"), F.sum("n").alias("n")), "counts")


def summary(counts: DataFrame) -> Counts:
    total, distinct = counts.agg(F.sum("c"), F.sum((F.col("c") > 0).cast("bigint"))).first()
    # held-out texts have no say: tokens of training texts, and the end, by their training counts
    is_end = F.col("token") == int(np.array([END], np.uint64).view(np.int64)[0])
    seen_in_training = counts.where((F.col("c") > 0) | is_end)
    # a bound on the counts of the TOP tokens first, so that few others are sorted for them
    eighth = F.floor(8 * F.log2(F.col("c") + 1))
    by_size = sorted(((r.e, r["count"]) for r in seen_in_training.groupBy(eighth.alias("e")).count().collect()), reverse=True)
    least, seen = 0, 0
    for least, size in by_size:
        seen += size
        if seen >= TOP:
            break
    top = seen_in_training.where((eighth >= least) | is_end).orderBy(is_end.desc(), F.col("c").desc(), "token").limit(TOP).toPandas()
    token, c = top["token"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64)
    rank = np.lexsort((token, -c, token != END))       # the end first, then by training count
    ids = np.empty(len(token), np.int64)
    ids[rank] = np.minimum(np.arange(len(token)), VOCABULARY)
    by_id = np.zeros(VOCABULARY)
    by_id[ids[ids < VOCABULARY]] = c[ids < VOCABULARY]
    mid = ids == VOCABULARY
    order = np.argsort(token)
    return Counts(token[order], ids[order], c[order], int(total or 0), int(distinct or 0), (float(c[mid].sum()), int(mid.sum())),
                  (float((total or 0) - c.sum()), int((distinct or 0) - (c > 0).sum())), by_id)


def first_net(counts: Counts, seed: int = 5) -> Net:
    """The network that equals the smoothed unigram model."""
    rng = np.random.default_rng(seed)
    mass = counts.by_id.reshape(CLASSES, PER_CLASS) + 0.5
    cls = np.concatenate([mass.sum(axis=1), [counts.mid[0] + 0.5 * counts.mid[1] + 1e-3, counts.rare[0] + 0.5 * (counts.rare[1] + 1)]])
    f = lambda *shape, scale=0.1: (rng.standard_normal(shape) * scale).astype(np.float32)
    return Net(f(VOCABULARY + 2, 3 * HIDDEN), f(HIDDEN, 3 * HIDDEN, scale=0.2), np.zeros((HIDDEN, CLASSES + 2), np.float32),
               np.log(cls / cls.sum()).astype(np.float32), np.zeros((CLASSES, HIDDEN, PER_CLASS), np.float32),
               np.log(mass / mass.sum(axis=1, keepdims=True)).astype(np.float32))


def _blocks(v: np.ndarray) -> np.ndarray:
    """(gate, row, HIDDEN) from rows of the three gates side by side, each gate's in one piece of memory;
    the update and reset are negated, as ``_advance`` takes them."""
    v = np.ascontiguousarray(v.reshape(len(v), 3, HIDDEN).swapaxes(0, 1))
    np.negative(v[:2], out=v[:2])
    return v


def _advance(u: np.ndarray, g: np.ndarray, h: np.ndarray, state: np.ndarray) -> np.ndarray:
    """The next state of each row, into ``state``, from the blocks ``g`` of its gates' inputs, which
    become the gates; gives the state's share of the new state."""
    hu = np.matmul(h, u)
    zr, n, share = g[:2], g[2], hu[2]
    zr += hu[:2]
    np.exp(zr, out=zr)
    zr += 1
    np.reciprocal(zr, out=zr)
    n += zr[1] * share
    np.tanh(n, out=n)
    np.subtract(h, n, out=state)
    state *= zr[0]
    state += n
    return share


def _step(net: Net, g: np.ndarray, h: np.ndarray) -> tuple:
    """The next state of each row, from the inputs ``g`` of its gates; with the gates."""
    gates, state = _blocks(g), np.empty_like(h)
    share = _advance(_blocks(net.u), gates, h, state)
    return state, *gates, share


def _picked(v: np.ndarray, row: np.ndarray, at: np.ndarray, keep: bool) -> np.ndarray:
    """Log-softmax over the first axis at the given places; ``keep``: ``v`` becomes the log-softmax, else it is lost."""
    v -= v.max(axis=0)
    if keep:
        v -= np.log(np.exp(v).sum(axis=0))
        return v[row, at]
    out = v[row, at]
    out -= np.log(np.exp(v, out=v).sum(axis=0))
    return out


def _outputs(net: Net, h: np.ndarray, target: np.ndarray, grads: Net | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log P(class) + log P(word | class) of each target (class alone for the last two);
    with ``grads`` also adds the gradients of minus their sum and returns that by ``h``."""
    cls = CLASS_OF[target]
    order = np.argsort(cls, kind="stable")               # by class, the last two behind
    cls, h = cls[order], h[order]
    edges = np.searchsorted(cls, np.arange(CLASSES + 1, dtype=cls.dtype))
    m = edges[-1]
    runs = [(k, slice(edges[k], edges[k + 1])) for k in np.flatnonzero(np.diff(edges))]
    logp = net.c.T @ h.T                                                 # (class, row)
    logp += net.cb[:, None]
    at = np.arange(len(h))
    ordered = _picked(logp, cls, at, grads is not None)
    in_class = np.empty((PER_CLASS, m), h.dtype)                         # (word of the class, row)
    for k, run in runs:
        part = in_class[:, run]
        np.matmul(net.w[k].T, h[run].T, out=part)
        part += net.wb[k][:, None]
    word = WORD_OF[target[order[:m]]]
    ordered[:m] += _picked(in_class, word, at[:m], grads is not None)
    out = np.empty_like(ordered)
    out[order] = ordered
    if grads is None:
        return out, None
    d = np.exp(logp, out=logp)
    d[cls, at] -= 1
    grads.c += (d @ h).T
    grads.cb += d.sum(axis=1)
    by_h = d.T @ net.c.T
    d = np.exp(in_class, out=in_class)
    d[word, at[:m]] -= 1
    for k, run in runs:
        grads.w[k] += (d[:, run] @ h[run]).T
        by_h[run] += d[:, run].T @ net.w[k].T
    if runs:
        present = [k for k, _ in runs]
        grads.wb[present] += np.add.reduceat(d, edges[present], axis=1).T
    dh = np.empty_like(by_h)
    dh[order] = by_h
    return out, dh


def gradients(net: Net, ids: np.ndarray, target: np.ndarray, h: np.ndarray, grads: Net) -> tuple[float, np.ndarray]:
    """Minus the log-likelihood of the targets of a window (step, lane) and the last state;
    its gradients, cut off at the first state ``h``, are added to ``grads``."""
    steps, lanes = ids.shape
    live = (ids != 0)[:, :, None].astype(h.dtype)          # a text's end clears the state
    z, r, n = gates = _blocks(net.x).take(ids, axis=1)
    u = _blocks(net.u)
    states, before, hn = (np.empty((steps, lanes, HIDDEN), h.dtype) for _ in range(3))
    for k in range(steps):
        hn[k] = _advance(u, gates[:, k], np.multiply(h, live[k], out=before[k]), states[k])
        h = states[k]
    out, dout = _outputs(net, states.reshape(-1, HIDDEN), target.reshape(-1), grads)
    dout = dout.reshape(steps, lanes, HIDDEN)
    # what a state's gradient becomes at the gates (update, reset, new), and at the state's share of them
    to_gates = np.empty((steps, lanes, 3, HIDDEN), h.dtype)
    to_gates[:, :, 0] = (before - n) * z * (1 - z)
    to_gates[:, :, 2] = (1 - z) * (1 - n * n)
    to_gates[:, :, 1] = to_gates[:, :, 2] * hn * r * (1 - r)
    to_share = to_gates.copy()
    to_share[:, :, 2] *= r
    passed = z * live
    back = np.ascontiguousarray(net.u.T)
    all_dh = np.empty_like(states)
    dh = np.zeros((lanes, HIDDEN), h.dtype)
    for k in range(steps - 1, -1, -1):
        np.add(dh, dout[k], out=all_dh[k])
        by_share = np.multiply(to_share[k], all_dh[k][:, None], out=to_share[k])
        dh = by_share.reshape(lanes, -1) @ back
        dh *= live[k]
        dh += all_dh[k] * passed[k]
    to_gates *= all_dh[:, :, None]
    dx, dhu = to_gates, to_share
    grads.u += before.reshape(-1, HIDDEN).T @ dhu.reshape(-1, 3 * HIDDEN)
    flat = ids.reshape(-1).astype(np.uint16)
    order = np.argsort(flat, kind="stable")               # each id's gradients are added up once a window
    first = np.flatnonzero(np.diff(flat[order].astype(np.int32), prepend=-1))
    grads.x[flat[order[first]]] += np.add.reduceat(dx.reshape(-1, 3 * HIDDEN)[order], first, axis=0)
    return -float(out.sum()), h


class Trainer:
    """A copy of a network that learns by Adam; weights, gradients and means lie in flat arrays."""

    def __init__(self, parts: list[np.ndarray], rate: float):
        self.weights = np.concatenate([p.reshape(-1) for p in parts])
        self.net, self.rate, self.t = _viewed(self.weights, parts), rate, 0
        self.g, self.m, self.v = (np.zeros_like(self.weights) for _ in range(3))
        self.grads = _viewed(self.g, parts)

    def fit(self, stream: np.ndarray) -> None:
        """Truncated backpropagation once over a stream of ids (each text ends with 0), in ``LANES``
        sub-streams whose lengths differ by one token at most (fewer lanes where it has fewer tokens)."""
        lanes = min(LANES, len(stream) - 1)
        if lanes < 1:
            return
        length, longer = divmod(len(stream) - 1, lanes)
        start = np.arange(lanes) * length + np.minimum(np.arange(lanes), longer)
        h = np.zeros((lanes, HIDDEN), np.float32)
        for a in range(0, length, STEPS):
            at = np.arange(a, min(a + STEPS, length))[:, None] + start
            h = self._update(stream[at], stream[at + 1], h)
        if longer:
            at = start[None, :longer] + length
            self._update(stream[at], stream[at + 1], h[:longer])

    def _update(self, ids: np.ndarray, target: np.ndarray, h: np.ndarray) -> np.ndarray:
        g, m, v = self.g, self.m, self.v
        g[:] = 0
        _, h = gradients(self.net, ids, target, h, self.grads)
        g *= 1 / target.size
        g *= min(1.0, 1.0 / max(float(np.sqrt(g @ g)), 1e-9))
        self.t += 1
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        self.weights -= self.rate / (1 - 0.9**self.t) * m / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)
        return h


def _viewed(flat: np.ndarray, like: list[np.ndarray]) -> Net:
    edges = np.cumsum([p.size for p in like])[:-1]
    return Net(*[part.reshape(p.shape) for part, p in zip(np.split(flat, edges), like, strict=True)])


def likelihood(net: Net, ids: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Natural log-likelihood of each text; ``ids`` holds the texts' tokens one after another,
    each with its end, ``bound`` where they start."""
    length = np.diff(bound)
    total = np.zeros(len(length))
    order = np.argsort(-length, kind="stable")
    x, u = _blocks(net.x), _blocks(net.u)
    for low in range(0, len(order), LOCKSTEP):
        docs = order[low:low + LOCKSTEP]
        start, n = bound[docs], length[docs]
        h, before, shorter = np.zeros((len(docs), HIDDEN), x.dtype), np.zeros(len(docs), np.int64), -n
        for a in range(0, int(n[0]), 2 * STEPS):
            # texts longer than each step come first
            live = np.searchsorted(shorter, -np.arange(a, min(a + 2 * STEPS, int(n[0]))), "left")
            edge = np.concatenate([[0], np.cumsum(live)])
            states, targets = np.empty((edge[-1], HIDDEN), x.dtype), np.empty(edge[-1], np.int64)
            for k, (m, first, last) in enumerate(zip(live.tolist(), edge[:-1].tolist(), edge[1:].tolist(), strict=True), a):
                state = states[first:last]
                _advance(u, x.take(before[:m], axis=1), h[:m], state)
                h, before = state, ids.take(start[:m] + k, out=targets[first:last])
            out, _ = _outputs(net, states, targets)
            rows = docs[np.arange(edge[-1]) - np.repeat(edge[:-1], live)]
            total += np.bincount(rows, out, minlength=len(total))
    return total


def _encoded(column, counts: Counts):
    """Per chunk of rows: (first row, ids with ends, bounds, training counts (-1: rare), the rare tokens' rows and hashes)."""
    for w in words(column):
        length = np.diff(w.row_bounds())
        at = np.minimum(np.searchsorted(counts.tokens, w.hash), max(0, len(counts.tokens) - 1))
        top = counts.tokens[at] == w.hash if len(counts.tokens) else np.zeros(len(w.hash), bool)
        ids = np.where(top, counts.ids[at] if len(counts.tokens) else 0, VOCABULARY + 1)
        c = np.where(top, counts.count[at] if len(counts.tokens) else 0, -1)
        bound = np.concatenate([[0], np.cumsum(length + 1)])
        place = np.arange(len(w.hash)) + (w.row - w.first)
        all_ids, all_c = np.zeros(bound[-1], np.int64), np.full(bound[-1], counts.by_id[0])
        all_ids[place], all_c[place] = ids, c
        yield w.first, all_ids, bound, all_c, w.row[~top], w.hash[~top].view(np.int64)


def _task_weights(shipped, rate: float):
    """mapInArrow function: trains on the texts of a partition, then gives its weights and tokens."""

    def run(batches):
        parts, c = shipped.value
        counts, trainer = Counts(*c), Trainer(parts, rate)
        slab, held, tokens = [], 0, 0

        def flush():
            trainer.fit(np.concatenate([[0], *slab]))
            slab.clear()

        for batch in batches:
            for _, ids, bound, _, _, _ in _encoded(batch.column(0), counts):
                slab.append(ids)
                held, tokens = held + int(bound[-1]), tokens + int(bound[-1])
                if held >= SLAB:
                    flush()
                    held = 0
        if held:
            flush()
        if tokens:
            flat = trainer.weights
            lists = pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([pa.array([tokens], pa.int64()), lists], ["tokens", "weights"])

    return run


def train(documents: DataFrame, in_training: Column, counts: Counts) -> Net:
    """Fit the network on all training texts, in tasks: each text in one of the rounds."""
    spark = documents.sparkSession
    net = first_net(counts)
    order = F.pmod(F.xxhash64("doc_id", "text", F.lit("round")), F.lit(ROUNDS))
    rows = documents.where(in_training).select("text", order.alias("round"))
    for k in range(ROUNDS):
        shipped = spark.sparkContext.broadcast((net.parts(), counts.parts()))
        own = rows.where(F.col("round") == k).select("text")
        sets = materialize(own.mapInArrow(_task_weights(shipped, RATE * (1 - k / ROUNDS)), "tokens long, weights array<float>"), "weights")
        share = F.sum(F.round(F.col("w").cast("double") * UNIT).cast("bigint") * F.col("tokens")) / (F.sum("tokens") * F.lit(float(UNIT)))
        mean = sets.select("tokens", F.posexplode("weights").alias("at", "w")).groupBy("at").agg(share.alias("w")).toPandas()
        shipped.unpersist()
        if len(mean):
            net = _viewed(mean.sort_values("at")["w"].to_numpy(np.float32), net.parts())
    return net


def scored(documents: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row."""
    spark = documents.sparkSession
    table = count_tokens(documents, ~held_out)
    counts = summary(table)
    net = train(documents, ~held_out, counts)
    shipped = spark.sparkContext.broadcast((net.parts(), counts.parts()))

    def score(column: pa.Array) -> pa.Array:
        parts, c = shipped.value
        own, model = Counts(*c), Net(*parts)
        size = len(column)
        n, known, base, gru = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size), np.zeros(size)
        rare_rows, rare = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        ids, bounds, rows = [], [0], []

        def flush():
            if rows:
                gru[rows[0]:rows[0] + len(bounds) - 1] += likelihood(model, np.concatenate(ids), np.array(bounds)) / np.log(10)
            ids.clear()
            bounds[:] = [0]
            rows.clear()

        for first, i, bound, count, r, h in _encoded(column, own):
            row = np.repeat(np.arange(first, first + len(bound) - 1), np.diff(bound))
            n[first:first + len(bound) - 1] = np.diff(bound)
            top = count >= 0
            known += np.bincount(row[count > 0], minlength=size)
            logs = np.log10(np.maximum(count, 0) + 0.5)
            base += np.bincount(row[top], logs[top], minlength=size)
            mid = i == VOCABULARY
            gru += np.bincount(row[mid], logs[mid] - np.log10(own.mid[0] + 0.5 * own.mid[1]), minlength=size)
            rare_rows.append(r)
            rare.append(h)
            rows.append(first)
            ids.append(i)
            bounds.extend((bounds[-1] + bound[1:]).tolist())
            if bounds[-1] > 2_000_000:                  # texts run in lockstep in slabs of bounded size
                flush()
        flush()
        r, h = np.concatenate(rare_rows), np.concatenate(rare)
        offsets = np.searchsorted(r, np.arange(size + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(h))
        return pa.StructArray.from_arrays([pa.array(n), pa.array(known), pa.array(base), pa.array(gru), lists], ["n", "known", "base", "gru", "rare"])

    run = F.arrow_udf(score, "struct<n:bigint,known:bigint,base:double,gru:double,rare:array<bigint>>").asNondeterministic()
    rows = documents.select("doc_id", held_out.alias("held_out"), run("text").alias("r")).select("doc_id", "held_out", "r.*")
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "scored")
    sums = (rows.select("row", F.explode("rare").alias("token")).join(table.select("token", "c"), "token")
            .groupBy("row").agg(F.sum(F.log10(F.col("c") + 0.5)).alias("logs"), F.sum((F.col("c") > 0).cast("bigint")).alias("more"), F.count("*").alias("m")))
    joined = rows.drop("rare").join(sums, "row", "left").na.fill({"logs": 0.0, "more": 0, "m": 0})
    base_total = float(np.log10(counts.total + 0.5 * (counts.distinct + 1)))
    rare_total = float(np.log10(counts.rare[0] + 0.5 * (counts.rare[1] + 1)))
    return joined.select("doc_id", "held_out", F.col("n").alias("n_tokens"), (F.col("known") + F.col("more")).alias("n_known"),
                         F.lit(counts.total).cast("bigint").alias("train_tokens"),
                         (F.col("base") + F.col("logs") - F.col("n") * F.lit(base_total)).alias("base_score"),
                         (F.col("gru") + F.col("logs") - F.col("m") * F.lit(rare_total)).alias("score"))
