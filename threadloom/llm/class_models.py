"""Operator 2: toxicity by class-conditional Kneser-Ney models of character expressions.

An expression is six characters of the lower-cased text (what sorts before "0", such as spaces and marks, counts as a
space): five of context and the one they predict. Each class has a whole model of the text. Its highest order takes the
counts of the class's labelled texts, less absolute discounts; the discounted mass of a context goes to a shared
backoff, the interpolated Kneser-Ney model of orders five to one, whose counts are continuation counts: behind how many
distinct characters an expression is found in the whole corpus. The lowest order is mixed with a uniform one.

Every character of a text, and the blank behind it, is predicted by both models; the logarithm of the two probabilities'
ratio is its evidence, of either sign. Of a text this makes two log-likelihood ratios of the classes:

* plain: the whole text by one model against the whole text by the other, divided by the number of characters;
* by words: the text as ordinary words of which one, any with equal chance, comes from the toxic model, against all of
  them by the ordinary model: the logarithm of the mean of the words' likelihood ratios. A word is a run of characters
  and the blanks behind it, cut every 32 characters.

A logistic plane with weights that aren't negative turns both into a score. It is fitted to evidence from models of the
other half of the labelled rows, by cells of evidence, which bound what the driver gets.

Counts are made by task, dealt by ranges of the context's hash and added there; the lower orders are aggregates and joins.
What is sent to the tasks are the evidence of the labelled rows' expressions and of their contexts (any other expression
has that of its context's backoff masses, or none), which the labelled sample bounds.

Labels come from folds 1 to 4 (crc32 of the id as text, modulo 5), at most `sample` rows, those with the smallest hash of
the id: a parameter, and the only bound. The shared counts cover every document.

Defined cases: null and empty texts have no evidence (0) and the score of that; a null doc_id is never labelled and is
scored like others; without labels of both kinds every score is the share of label 1 (0.5 without any label); null
labels are no labels, any above 0 is 1, and of an id with several the largest counts; repeated rows count as often as
they occur and are scored alike; other columns are ignored, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RANGE_BYTES, batch_of, crc_fold, lean, materialize, mix64, pack, release, table, unpack
from .toxicity import SAMPLE, _labelled

ORDER, WORD = 6, 32
#: Expressions that a task holds before it sends their counts on.
HELD = 1_000_000
#: Sides of a cell of plain and of word evidence, and their bounds.
CELLS, BOUNDS = np.array([0.005, 0.05]), np.array([2.0, 60.0])
MODELS = (("c0", "c1"), ("c2", "c3"), ("c0 + c2", "c1 + c3"))


def _hashes(window):
    """64-bit hashes of contexts and of whole expressions; window(k): the k-th characters."""
    h = np.uint64(0)
    for k in range(ORDER):
        context = h
        h = (h * np.uint64(0x100000001B3)) ^ (window(k).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return mix64(context), mix64(h)


def _expressions(texts: list[str | None]):
    """(first document, characters, where expressions start, their documents, expressions of each document) in slabs."""
    i = 0
    while i < len(texts):
        parts, size, j = [], 0, i
        while j < len(texts) and (not parts or size < 1 << 20):
            own = " " * (ORDER - 1) + texts[j].lower() + " " if texts[j] else ""
            parts.append(own)
            size += len(own) + 1
            j += 1
        c = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        c = np.where(c < 48, np.uint32(32), c)
        lengths = np.array([max(0, len(p) - ORDER + 1) for p in parts])
        starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]])
        owner = np.repeat(np.arange(len(parts)), lengths)
        at = np.arange(len(owner)) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)
        if len(at):
            yield i, c, at, owner, lengths
        i = j


def _summed(codes: np.ndarray, rows: np.ndarray):
    """Distinct codes, ascending, with their characters and the sums of their counts."""
    order = np.argsort(codes)
    codes = codes[order]
    begins = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    rows = rows[order]
    return codes[begins], np.concatenate([rows[begins, :ORDER], np.add.reduceat(rows[:, ORDER:], begins, axis=0)], 1)


_PACKED = pa.schema([("range", pa.int32()), ("counts", pa.binary())])


def _count(known, ranges: int):
    """The distinct expressions of each task's documents by ranges of contexts, with their counts by half and class."""

    def run(batches):
        parts, size = [], 0

        def merged():
            return _summed(np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts]))

        def sent(rows):
            context, _ = _hashes(lambda k: rows[:, k])
            r = ((context >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(r, kind="stable")
            cuts = np.searchsorted(r[order], np.arange(ranges + 1))
            for k in np.flatnonzero(np.diff(cuts)):
                own = rows[order[cuts[k] : cuts[k + 1]]]
                yield batch_of(_PACKED, [k], [pack(*own.astype(np.uint32).T)])

        for batch in batches:
            kinds = _labelled(batch.column(0).to_pylist(), known.value)
            for first, c, at, owner, _ in _expressions(batch.column(1).to_pylist()):
                _, own = _hashes(lambda k: c[k : len(c) - ORDER + 1 + k])
                own, kind = own[at], kinds[first + owner]
                order = np.argsort(own)
                own = own[order]
                new = np.concatenate([[True], own[1:] != own[:-1]])
                number, begins = np.cumsum(new) - 1, np.flatnonzero(new)
                rows = np.zeros((len(begins), ORDER + 4), np.int64)
                for k in range(ORDER):
                    rows[:, k] = c[at[order[begins]] + k]
                kind = kind[order]
                for k in range(4):
                    if (some := kind == k).any():
                        rows[:, ORDER + k] = np.bincount(number[some], minlength=len(rows))
                parts.append((own[begins], rows.astype(np.uint32)))
                size += len(rows)
                if size > 2 * HELD:
                    parts = [merged()]
                    size = len(parts[0][0])
                    if size > HELD:
                        yield from sent(parts[0][1])
                        parts, size = [], 0
        if parts:
            yield from sent(merged()[1])

    return run


def _add(batches):
    """A row for each distinct expression of a range: its text, the hashes of context and whole, and its counts."""
    schema = pa.schema([("gram", pa.string()), ("ctx", pa.int64()), ("code", pa.int64()), *((f"c{k}", pa.int64()) for k in range(4))])
    held: dict = {}
    for batch in batches:
        for r, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.setdefault(r, []).append(counts)
    for r in sorted(held):
        rows = np.concatenate([np.stack(unpack(x, *["u4"] * (ORDER + 4)), 1) for x in held.pop(r)]).astype(np.int64)
        _, rows = _summed(_hashes(lambda k: rows[:, k])[1], rows)
        for i in range(0, len(rows), 100_000):
            own = rows[i : i + 100_000]
            ctx, code = _hashes(lambda k: own[:, k])
            text = own[:, :ORDER].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            grams = [text[k : k + ORDER] for k in range(0, len(text), ORDER)]
            yield batch_of(schema, grams, ctx.view(np.int64), code.view(np.int64), *own[:, ORDER:].T)


def _discounts(n):
    """Three absolute discounts, of counts 1, 2 and more, from how many counts are 1, 2, 3 and 4 (Chen and Goodman)."""
    once, twice, thrice, four = (F.sum((n == k).cast("long")) for k in (1, 2, 3, 4))
    over = lambda a, b: a / F.greatest(b, F.lit(1))  # noqa: E731  # 0: not used
    y = over(once, once + 2 * twice)
    found = [1 - over(2 * y * twice, once), 2 - over(3 * y * thrice, twice), 3 - over(4 * y * four, thrice)]
    found = F.array(*(F.least(F.greatest(d, F.lit(0.01)), F.lit(float(k))) for k, d in enumerate(found, 1)))
    return F.when((once > 0) & (twice > 0) & (thrice > 0) & (four > 0), found).otherwise(F.array(*[F.lit(0.5)] * 3))


def _discount(discounts, n):
    return F.when(n > 0, F.get(discounts, (F.least(n, F.lit(3)) - 1).cast("int"))).otherwise(F.lit(0.0))


def continuation_model(grams: DataFrame) -> DataFrame:
    """(gram, p) of the expressions one shorter than the distinct ones given: interpolated Kneser-Ney of all lower orders."""
    levels, above = {}, grams
    for n in range(ORDER - 1, 0, -1):
        above = levels[n] = materialize(above.groupBy(F.expr(f"substring(gram, 2, {n})").alias("gram")).agg(F.count("*").alias("n")), "continuations")
    p = None
    for n, level in sorted(levels.items()):
        own = level.crossJoin(F.broadcast(level.agg(_discounts(F.col("n")).alias("d")))).withColumn("cut", _discount("d", F.col("n")))
        facts = [F.sum("n").alias("total"), F.sum("cut").alias("mass"), F.count("*").alias("types")]
        if n == 1:
            own = own.crossJoin(F.broadcast(own.agg(*facts))).withColumn("low", 1 / F.col("types"))
        else:
            own = own.withColumn("before", F.expr(f"substring(gram, 1, {n - 1})")).withColumn("after", F.expr("substring(gram, 2)"))
            own = own.join(own.groupBy("before").agg(*facts), "before").join(p.select(F.col("gram").alias("after"), F.col("p").alias("low")), "after")
        p = own.select("gram", ((F.col("n") - F.col("cut") + F.col("mass") * F.col("low")) / F.col("total")).alias("p"))
    out = materialize(p, "backoff")
    release(*levels.values())
    return out


def class_evidence(grams: DataFrame, backoff: DataFrame) -> DataFrame:
    """(whole, code, e0, e1, e2): log ratios of both classes' probabilities by the models of half 0, half 1 and all labelled rows.

    Of whole expressions, or (whole: false) of contexts: there of the masses that go to the backoff. Null where a model
    doesn't hold the expression.
    """
    sides = [f"{m}{k}" for m in range(3) for k in (0, 1)]
    counted = grams.where("c0 + c1 + c2 + c3 > 0").select("gram", "ctx", "code", *(F.expr(MODELS[m][k]).alias(f"n{m}{k}") for m in range(3) for k in (0, 1)))
    counted = counted.crossJoin(F.broadcast(counted.agg(*(_discounts(F.col(f"n{s}")).alias(f"d{s}") for s in sides))))
    counted = counted.select("gram", "ctx", "code", *(f"n{s}" for s in sides), *(_discount(f"d{s}", F.col(f"n{s}")).alias(f"cut{s}") for s in sides))
    contexts = counted.groupBy("ctx").agg(*(F.sum(f"n{s}").alias(f"t{s}") for s in sides), *(F.sum(f"cut{s}").alias(f"mass{s}") for s in sides))

    def mass(s):
        return F.when(F.col(f"t{s}") > 0, F.col(f"mass{s}") / F.col(f"t{s}")).otherwise(F.lit(1.0))

    def probability(s):
        return F.when(F.col(f"t{s}") > 0, (F.col(f"n{s}") - F.col(f"cut{s}")) / F.col(f"t{s}")).otherwise(F.lit(0.0)) + mass(s) * F.col("p")

    def ratios(kind, of):
        return [F.when(F.col(f"{kind}{m}0") + F.col(f"{kind}{m}1") > 0, F.log(of(f"{m}1")) - F.log(of(f"{m}0"))).alias(f"e{m}") for m in range(3)]

    after = backoff.select(F.col("gram").alias("after"), "p")
    whole = counted.withColumn("after", F.expr("substring(gram, 2)")).join(contexts, "ctx").join(after, "after")
    return whole.select(F.lit(True).alias("whole"), "code", *ratios("n", probability)).union(contexts.select(F.lit(False).alias("whole"), F.col("ctx").alias("code"), *ratios("t", mass)))


class _Evidence:
    """Evidence by code: a table by the first bits of the code, and the codes that don't get a place there."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        bits = max(8, len(codes).bit_length())
        self.shift = np.uint64(64 - bits)
        order = np.argsort(codes)
        codes, values = codes[order], values[order]
        place = (codes >> self.shift).astype(np.int64)
        first = np.concatenate([[True], place[1:] != place[:-1]])[: len(codes)]
        self.keys = (np.arange(1 << bits, dtype=np.uint64) ^ np.uint64(1)) << self.shift  # of another place
        self.values, self.more = np.zeros(1 << bits, np.float32), np.zeros(1 << bits, bool)
        self.keys[place[first]], self.values[place[first]] = codes[first], values[first]
        self.more[place[~first]] = True
        self.rest, self.rest_values = codes[~first], values[~first]

    def __call__(self, codes: np.ndarray):
        """Values, 0 for unknown codes, and which are known."""
        place = (codes >> self.shift).astype(np.int64)
        known = self.keys[place] == codes
        out = np.where(known, self.values[place], np.float32(0))
        if len(self.rest) and len(some := np.flatnonzero(~known & self.more[place])):
            at = np.minimum(np.searchsorted(self.rest, codes[some]), len(self.rest) - 1)
            hit = self.rest[at] == codes[some]
            out[some[hit]], known[some[hit]] = self.rest_values[at[hit]], True
        return out, known


def _features(texts, model) -> np.ndarray:
    """Plain and word evidence of each text."""
    out = np.zeros((len(texts), 2))
    whole, context = model
    for first, c, at, owner, lengths in _expressions(texts):
        ctx, code = _hashes(lambda k: c[k : len(c) - ORDER + 1 + k])
        e, known = whole(code[at])
        rest = np.flatnonzero(~known)
        e[rest] = context(ctx[at[rest]])[0]
        e = e.astype(float)
        blank = c[at + ORDER - 1] == 32
        head = np.concatenate([[True], (owner[1:] != owner[:-1]) | (~blank[1:] & blank[:-1])])
        starts = np.flatnonzero(head)
        head |= (np.arange(len(at)) - starts[np.cumsum(head) - 1]) % WORD == 0
        starts = np.flatnonzero(head)
        words, of = np.add.reduceat(e, starts), owner[starts]
        some = np.flatnonzero(lengths)
        begins = np.searchsorted(of, some)
        top = np.maximum.reduceat(words, begins)
        n = np.diff(np.append(begins, len(of)))
        out[first + some, 0] = np.add.reduceat(words, begins) / lengths[some]
        out[first + some, 1] = top + np.log(np.add.reduceat(np.exp(words - np.repeat(top, n)), begins) / n)
    return out


def _cells(known, models):
    """Labelled documents by cell of their evidence, each from the model of the other half."""
    schema = pa.schema([("plain", pa.int32()), ("words", pa.int32()), ("label", pa.int32()), ("n", pa.int64())])

    def run(batches):
        tables = [tuple(_Evidence(*x) for x in m) for m in models.value]
        held: dict = {}
        for batch in batches:
            kinds = _labelled(batch.column(0).to_pylist(), known.value)
            for half in (0, 1):
                rows = np.flatnonzero((kinds >= 0) & (kinds // 2 == half))
                if len(rows):
                    x = _features(batch.column(1).take(pa.array(rows)).to_pylist(), tables[1 - half])
                    cells = np.floor(np.clip(x, -BOUNDS, BOUNDS) / CELLS).astype(int)
                    for cell in zip(*cells.T.tolist(), (kinds[rows] % 2).tolist(), strict=True):
                        held[cell] = held.get(cell, 0) + 1
        if held:
            yield batch_of(schema, *zip(*held, strict=True), list(held.values()))

    return run


def _scored(model, weights, bias: float):
    def run(batches):
        tables = tuple(_Evidence(*x) for x in model.value)
        for batch in batches:
            x = np.clip(_features(batch.column(1).to_pylist(), tables), -BOUNDS, BOUNDS) @ weights + bias
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(x, -50, 50))))], names=["doc_id", "score"])

    return run


def fit_plane(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic weights (not negative) and intercept of weighted points; a feature whose weight would be negative goes."""
    mean = np.average(x, axis=0, weights=n)
    wide = np.sqrt(np.average((x - mean) ** 2, axis=0, weights=n)) + 1e-9
    z = np.concatenate([(x - mean) / wide, np.ones((len(x), 1))], 1)
    used = np.arange(z.shape[1])
    while True:
        w = np.zeros(z.shape[1])
        w[-1] = math.log((y * n).sum() / ((1 - y) * n).sum())
        ridge = np.append(np.full(len(used) - 1, 0.01), 0)
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -50, 50)))
            own = z[:, used]
            g = own.T @ (n * (y - p)) - ridge * w[used]
            h = (own * (n * p * (1 - p) + 1e-9)[:, None]).T @ own + np.diag(ridge)
            w[used] += np.clip(np.linalg.solve(h, g), -2, 2)
        if (w[:-1] >= 0).all():
            return w[:-1] / wide, float(w[-1] - (w[:-1] / wide * mean).sum())
        used = np.delete(used, int(np.argmin(w[used[:-1]])))


def compare_classes(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """doc_id and score of every document."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    ids = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (crc_fold(F.col("doc_id")) != 0))
    ids = ids.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max(label) > 0).cast("int").alias("y"))
    ids = ids.select("doc_id", (2 * (crc_fold(F.col("doc_id")) > 2).cast("int") + F.col("y")).alias("kind"))
    rows = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).toPandas().sort_values("doc_id")
    keys, kinds = rows["doc_id"].to_numpy(np.int64), rows["kind"].to_numpy(np.int64)
    y = kinds % 2
    if not len(y) or y.min() == y.max():
        return texts.select("doc_id", F.lit(float(y.mean()) if len(y) else 0.5).alias("score"))
    known = spark.sparkContext.broadcast((keys, kinds))
    ranges = max(8, math.ceil((texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / RANGE_BYTES))
    counted = texts.mapInArrow(lean(_count(known, ranges)), "range int, counts binary").repartitionById(ranges, F.col("range"))
    grams = materialize(counted.mapInArrow(lean(_add), "gram string, ctx long, code long, c0 long, c1 long, c2 long, c3 long"), "grams")
    backoff = continuation_model(grams)
    found = class_evidence(grams, backoff).toArrow()
    release(grams, backoff)
    codes, whole = found["code"].to_numpy().view(np.uint64), found["whole"].to_numpy()
    models = []
    for m in range(3):
        e = found[f"e{m}"].to_numpy().astype(np.float32)
        models.append([(codes[some], e[some]) for some in (whole & ~np.isnan(e), ~whole & ~np.isnan(e))])
    halves, model = spark.sparkContext.broadcast(models[:2]), spark.sparkContext.broadcast(models[2])
    cells = texts.mapInArrow(lean(_cells(known, halves)), "plain int, words int, label int, n long").groupBy("plain", "words", "label").agg(F.sum("n").alias("n")).toPandas()
    kind = docs.schema["doc_id"].dataType.simpleString()
    if cells["label"].nunique() < 2:  # no document of one of the classes
        return texts.select("doc_id", F.lit(float(y.mean())).alias("score"))
    x = (cells[["plain", "words"]].to_numpy(float) + 0.5) * CELLS
    weights, bias = fit_plane(x, cells["label"].to_numpy(float), cells["n"].to_numpy(float))
    return texts.mapInArrow(lean(_scored(model, weights, bias)), f"doc_id {kind}, score double")


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    out = compare_classes(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", (crc_fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
