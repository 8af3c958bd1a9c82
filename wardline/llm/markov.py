"""Character Markov models, counted with Spark.

Symbols are ``a``-``z``, a digit class, seven punctuation marks, a class for
everything else and the boundary.  Counts are kept in one of two forms.  The
gram tables (``count_grams``, ``log_ratios``) hold every context of up to
``ORDER`` symbols exactly, in Spark tables that grow with the distinct ones.
``Model`` is an array of fixed shape; contexts of more than two symbols share
its ``CONTEXTS`` rows by hash, so only orders 0-2 are exact.
Probabilities interpolate all orders with Witten-Bell weights: the order with
context count n and t distinct followers weighs n / (n + t) against the
shorter ones.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm import kernels as K

ORDER = 4
CONTEXTS = 1 << 14
DIGIT, PUNCT, OTHER, EDGE = 26, 27, 34, 35
SYMBOLS = 36

CODE = np.full(256, OTHER, np.uint8)
CODE[ord("a"):ord("z") + 1] = np.arange(26)
CODE[ord("A"):ord("Z") + 1] = np.arange(26)
CODE[ord("0"):ord("9") + 1] = DIGIT
for _i, _c in enumerate("/.-_%=&"):
    CODE[ord(_c)] = PUNCT + _i
_STEP = np.uint64(0x9E3779B97F4A7C15)


def encode(text: bytes) -> np.ndarray:
    """Symbols of a string between two boundaries."""
    return np.concatenate(([EDGE], CODE[np.frombuffer(text, np.uint8)], [EDGE])).astype(np.int64)


def context_rows(symbols: np.ndarray, order: int) -> np.ndarray:
    """Row of the ``order`` symbols before every symbol but the first."""
    n = len(symbols) - 1
    if order == 0:
        return np.zeros(n, np.int64)
    padded = np.concatenate((np.full(order - 1, EDGE), symbols))
    code = np.zeros(n, np.int64)
    for j in range(order):
        code = code * SYMBOLS + padded[j: j + n]
    if SYMBOLS ** order <= CONTEXTS:
        return code
    return (K.mix(code.astype(np.uint64) * _STEP) % np.uint64(CONTEXTS)).astype(np.int64)


def cells(symbols: np.ndarray) -> np.ndarray:
    """(ORDER + 1, n) cell numbers of every symbol but the first in the count array."""
    after = symbols[1:]
    return np.stack([(order * CONTEXTS + context_rows(symbols, order)) * SYMBOLS + after for order in range(ORDER + 1)])


SHAPE = (ORDER + 1, CONTEXTS, SYMBOLS)


class Model:
    """Interpolated log-probabilities from a count array."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts.reshape(SHAPE)
        self.total = self.counts.sum(axis=2)
        self.kinds = (self.counts > 0).sum(axis=2)

    def probabilities(self, symbols: np.ndarray) -> np.ndarray:
        """P(symbol | symbols before it) of every symbol but the first."""
        after = symbols[1:]
        p = np.full(len(after), 1.0 / SYMBOLS)
        for order in range(ORDER + 1):
            row = context_rows(symbols, order)
            n, t = self.total[order, row], self.kinds[order, row]
            p = np.where(n > 0, (self.counts[order, row, after] + t * p) / np.maximum(n + t, 1), p)
        return p

    def mean_log(self, symbols: np.ndarray) -> float:
        """Log-likelihood per symbol."""
        return float(np.log(self.probabilities(symbols)).mean())


WIDTH = [SYMBOLS ** (order + 1) for order in range(ORDER + 1)]       # a gram modulo WIDTH[k] is a cell of order k
UNIT = 1e-9                                                          # of a log-ratio, summed as integers


def grams(symbols: np.ndarray) -> np.ndarray:
    """Exact number of the ``ORDER`` symbols before and the symbol, for every symbol but the first."""
    n = len(symbols) - 1
    padded = np.concatenate((np.full(ORDER - 1, EDGE), symbols))
    code = np.zeros(n, np.int64)
    for j in range(ORDER + 1):
        code = code * SYMBOLS + padded[j: j + n]
    return code


def count_grams(rows: DataFrame, column: str, weights: list[str]) -> DataFrame:
    """(gram, one count per weight column) over all rows; ``column`` is binary, the weights are integers."""
    k = len(weights)

    def count(batches):
        for rb in batches:
            held = [rb.column(1 + i).to_numpy(zero_copy_only=False) for i in range(k)]
            at = [grams(encode(text)) for text in rb.column(0).to_pylist()]
            if not at:
                continue
            row = np.repeat(np.arange(len(at)), [len(a) for a in at])
            gram, back = np.unique(np.concatenate(at), return_inverse=True)
            sums = [np.bincount(back, weights=w[row].astype(float), minlength=len(gram)).astype(np.int64) for w in held]
            yield K.batch(["gram", *weights], [gram, *sums])

    schema = ", ".join(["gram long", *[f"{w} long" for w in weights]])
    out = rows.select(column, *weights).mapInArrow(count, schema)
    return out.groupBy("gram").agg(*[F.sum(w).alias(w) for w in weights])


def text_grams(rows: DataFrame, key: str, column: str) -> DataFrame:
    """(key, gram, n): the grams of every row's text and how often it holds them."""

    def split(batches):
        for rb in batches:
            found = [np.unique(grams(encode(text)), return_counts=True) for text in rb.column(1).to_pylist()]
            if found:
                at = np.repeat(np.arange(len(found)), [len(g) for g, _ in found])
                yield K.batch(["key", "gram", "n"], [rb.column(0).take(pa.array(at)), np.concatenate([g for g, _ in found]),
                                                     np.concatenate([n for _, n in found]).astype(np.int64)])

    return rows.select(key, column).mapInArrow(split, "key long, gram long, n long")


def log_ratios(wanted: DataFrame, counted: DataFrame, a: str, b: str) -> DataFrame:
    """(gram, ratio): log P_a - log P_b in ``UNIT`` of every wanted gram's symbol; ``counted`` holds the grams' counts.

    The counts of an order are those of the grams by their last symbols.  Orders 0-2 have at most ``WIDTH[2]``
    cells, all exact; the longer contexts are tables joined to the wanted grams.
    """
    spark = wanted.sparkSession
    low = counted.groupBy((F.col("gram") % WIDTH[2]).alias("gram")).agg(F.sum(a).alias(a), F.sum(b).alias(b)).toArrow()
    base = {"c2": np.arange(WIDTH[2])}
    for w in (a, b):
        counts = np.zeros(WIDTH[2])
        counts[low.column("gram").to_numpy()] = low.column(w).to_numpy()
        p = np.full((SYMBOLS,) * 3, 1.0 / SYMBOLS)
        for order in range(3):
            c = counts.reshape((SYMBOLS,) * 3).sum(axis=tuple(range(2 - order)), keepdims=True)
            n, t = c.sum(axis=-1, keepdims=True), (c > 0).sum(axis=-1, keepdims=True)
            p = np.where(n > 0, (c + t * p) / np.maximum(n + t, 1), p)
        base[f"p_{w}"] = p.ravel()
    out = (wanted.select("gram", (F.col("gram") % WIDTH[2]).alias("c2"))
           .join(spark.createDataFrame(pd.DataFrame(base)).hint("merge"), "c2"))
    for order in range(3, ORDER + 1):
        cell = (counted.groupBy((F.col("gram") % WIDTH[order]).alias("cell"))
                .agg(F.sum(a).alias(f"n_{a}"), F.sum(b).alias(f"n_{b}")))
        context = (cell.groupBy(F.expr(f"cell div {SYMBOLS}").alias("context"))
                   .agg(*[F.sum(f"n_{w}").alias(f"all_{w}") for w in (a, b)],
                        *[F.count_if(F.col(f"n_{w}") > 0).alias(f"kinds_{w}") for w in (a, b)]))
        out = (out.withColumn("cell", F.col("gram") % WIDTH[order]).withColumn("context", F.expr(f"cell div {SYMBOLS}"))
               .join(cell.hint("merge"), "cell", "left").join(context.hint("merge"), "context", "left"))
        for w in (a, b):
            n, t, p = F.col(f"all_{w}"), F.col(f"kinds_{w}"), F.col(f"p_{w}")
            out = out.withColumn(f"p_{w}", F.when(n > 0, (F.coalesce(f"n_{w}", F.lit(0)) + t * p) / (n + t)).otherwise(p))
        out = out.select("gram", f"p_{a}", f"p_{b}")
    return out.select("gram", F.round((F.log(f"p_{a}") - F.log(f"p_{b}")) / UNIT).cast("long").alias("ratio"))


def collect_counts(counted: DataFrame, weights: list[str]) -> list[np.ndarray]:
    """Dense arrays; at most (ORDER + 1) * CONTEXTS * SYMBOLS rows reach the driver."""
    table: pa.Table = counted.toArrow()
    cell = table.column("cell").to_numpy()
    out = []
    for w in weights:
        dense = np.zeros(int(np.prod(SHAPE)), np.float32)
        dense[cell] = table.column(w).to_numpy()
        out.append(dense)
    return out
