"""Quality rules by host: rule failures per host, shrunk with an empirical beta prior, judge its documents.

Every document is measured once; the numbers are written and both the host sums and the final join read
them, never the texts again. A host is any column that names where a document comes from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.sizes import broadcast_if_small
from ..plans.staging import staged
from .text import mix, pieces, windows, word_hashes

SYMBOLS = b"#*$%&|<>"
MEASURES = "word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


@dataclass(frozen=True)
class Rule:
    """``failed`` over the measures of a document; a host whose shrunk failure rate is above ``limit`` is bad."""
    name: str
    failed: str
    limit: float


RULES = (
    Rule("short", "n_words < 50", 0.6),
    Rule("repeats", "100 * n_repeat_words > 50 * n_words", 0.5),
    Rule("symbols", "10 * n_symbols > n_words", 0.5),
    Rule("lines", "5 * n_dup_lines > n_words", 0.5),
)
BASE = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def _sums(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[ends])


def _repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def _measure(batches):
    symbols = np.zeros(256, bool)
    symbols[list(SYMBOLS)] = True
    for batch in batches:
        cols = [[np.zeros(0, np.int64)] for _ in range(5)]
        for p in pieces(batch.column("text")):
            hashes = word_hashes(p)
            inside = np.zeros(len(p.data) + 1, np.int8)
            inside[p.starts] += 1
            inside[p.stops] -= 1
            chars = (np.cumsum(inside[:-1]) > 0) & ((p.data & 0xC0) != 0x80)
            # words that lie in some 3-word window found more than once in their document
            at, three = windows(p, hashes, 3)
            own = mix(three + p.document()[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            order = np.argsort(own)
            same = own[order][1:] == own[order][:-1]
            again = np.zeros(len(own), bool)
            again[order[1:][same]] = True
            again[order[:-1][same]] = True
            covered = np.zeros(len(hashes), bool)
            for j in range(3):
                covered[at[again] + j] = True
            raw = p.data.tobytes()
            for col, values in zip(cols, (p.n_words(), _sums(chars, p.ends), _sums(symbols[p.data], p.ends),
                                          np.array([_repeated_lines(raw[a:b]) for a, b in zip(p.ends[:-1], p.ends[1:])], np.int64),
                                          _sums(covered, p.borders))):
                col.append(values)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("host"), *[pa.array(np.concatenate(c)) for c in cols]],
            names=["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_measure, f"doc_id long, host string, n_words long, {MEASURES}")


def host_rates(measures: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per host: n and the shrunk failure rate of each rule, and ``bad``.

    The prior of a rule is the beta distribution with the mean and variance of the hosts' own rates (method of
    moments); where that is undefined (one host, no spread) its weight is one document."""
    failed = lambda r: F.coalesce(F.expr(r.failed), F.lit(False)).cast("long")
    hosts = measures.groupBy("host").agg(F.count(F.lit(1)).alias("n"), *[F.sum(failed(r)).alias(f"k_{r.name}") for r in rules])
    prior = hosts.agg(*[f for r in rules for f in (
        F.avg(F.col(f"k_{r.name}") / F.col("n")).alias(f"m_{r.name}"),
        F.var_samp(F.col(f"k_{r.name}") / F.col("n")).alias(f"v_{r.name}"))])
    rates = hosts.crossJoin(F.broadcast(prior))  # a global aggregate: exactly one row
    out, bad = [], F.lit(False)
    for r in rules:
        m, v = F.col(f"m_{r.name}"), F.col(f"v_{r.name}")
        weight = F.when((v > 0) & (m * (1 - m) > v), m * (1 - m) / v - 1).otherwise(1.0)
        rate = (F.col(f"k_{r.name}") + weight * m) / (F.col("n") + weight)
        out.append(rate.alias(f"rate_{r.name}"))
        bad = bad | (rate > r.limit)
    return rates.select("host", "n", *out, bad.alias("bad"))


def judged(docs: DataFrame, host: str = "source", rules: tuple[Rule, ...] = RULES, base: str = BASE) -> DataFrame:
    """doc_id, the measures, base_failed and kept: the document passes the base rules and its host is good.

    Null and empty texts have no words and fail the base rules. Documents with a null host share one host.
    Repeated rows count each. Other columns are ignored; an empty table gives no rows."""
    rows = staged(measured(docs, host), "measures")
    hosts = host_rates(rows, rules).select(F.col("host").alias("of"), "bad")
    full = rows.join(broadcast_if_small(staged(hosts, "hosts"), 8 << 20), F.col("host").eqNullSafe(F.col("of")), "left")
    failed = F.coalesce(F.expr(base), F.lit(False))
    return full.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), (~failed & ~F.coalesce("bad", F.lit(False))).alias("kept"))
