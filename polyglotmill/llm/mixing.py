"""Mixing sources to target weights (operator 7): iterative proportional fitting, in DataFrame operations only.

Documents are counted into cells (source, language, topic) with their tokens. A
document is kept with the probability of its cell, decided by a hash of its id.
Raking finds the probabilities: they start at KEEP_SHARE, and each step scales
the cells of every source, then of every language, then of every topic, so that
the tokens expected to be kept meet the value's target, but never beyond a
probability of one. The bound is inside the loop, so what a whole cell can't
give is asked of the others, in all three dimensions, until the largest miss
of a round is TOLERANCE of the kept tokens, or for ROUNDS rounds.

Targets: KEEP_SHARE of all tokens in shares proportional to tokens **
TEMPERATURE for each value of a dimension (a tempered mix), unless explicit
shares are given. No value can give more tokens than it has: such a target is
lowered to them, and the rest is shared by the other values in proportion. If
explicit shares leave too little to share, fewer tokens are kept. `marginals`
reports what was asked, targeted and met. The topic is a rule over text shape:
see `topic`; `rule` replaces it. The cells are as many as the distinct triples;
the driver sees sums only.

Cases: null source, language or topic is the value '(none)'. Null text has no
tokens; a text of spaces or line ends only has none either. Cells without
tokens get weight and probability 1. A null doc_id is decided by the text
'null'; repeated rows are decided alike, and ties can't arise. Very long texts
are counted in place. An empty table gives no rows. Only the named columns are
read; `sample` returns all columns unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

DIMENSIONS = ("source", "lang", "topic")
TEMPERATURE = 0.7
ROUNDS = 40
TOLERANCE = 1e-3
KEEP_SHARE = 0.8
#: Steps in which targets beyond what there is are lowered; each lowers one more value at least, or is the last.
FILLS = 12
#: Cells of one task at most, a few MB; they are raked so many rounds a job. More cells are raked by joins, a round a job, to the same result.
TASK_CELLS, TASK_ROUNDS = 20_000, 5
SEED = "mix-1"
SHORT_TOKENS, LONG_TOKENS, LINE_TOKENS = 60, 800, 12


def tokens(text: Column) -> Column:
    """Runs of characters other than space, tab, newline and carriage return."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r]+")), F.lit(0)).cast("long")


def topic(n: Column, lines: Column) -> Column:
    """The shape of a text: short, listed (few tokens a line), long, or prose."""
    return F.when(n < SHORT_TOKENS, "short").when(n < lines * LINE_TOKENS, "listed").when(n >= LONG_TOKENS, "long").otherwise("prose")


def described(docs: DataFrame, rule: Callable = topic) -> DataFrame:
    """doc_id, source, lang, topic, tokens of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    rows = docs.select("doc_id", *[F.coalesce(F.col(c).cast("string"), F.lit("(none)")).alias(c) for c in ("source", "lang")], tokens(text).alias("tokens"), lines.alias("lines"))
    return rows.select("doc_id", "source", "lang", F.coalesce(rule(F.col("tokens"), F.col("lines")), F.lit("(none)")).alias("topic"), "tokens")


def goals(cells: DataFrame, keep_share: float, temperature: float, shares: dict[str, dict[str, float]] | None) -> DataFrame:
    """dim, value, tokens, share (asked), target (in tokens) of each value of each dimension."""
    parts = []
    for d in DIMENSIONS:
        part = cells.groupBy(F.col(d).alias("value")).agg(F.sum("tokens").cast("double").alias("tokens"))
        mass = F.pow("tokens", F.lit(temperature))
        if shares and d in shares:
            given = F.create_map(*[F.lit(x) for v, share in shares[d].items() for x in (v, float(share))])
            mass = F.coalesce(given[F.col("value")], F.lit(0.0))
        parts.append(part.select(F.lit(d).alias("dim"), "value", "tokens", mass.alias("mass")))
    sizes = cut(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    totals = {r["dim"]: r for r in sizes.groupBy("dim").agg(F.sum("mass").alias("mass"), F.sum("tokens").alias("tokens")).collect()}  # three rows
    dims = lambda values: F.create_map(*[x for d, v in values.items() for x in (F.lit(d), F.lit(float(v)))])[F.col("dim")]
    if not totals:
        return sizes.select("dim", "value", "tokens", F.lit(0.0).alias("share"), F.lit(0.0).alias("target"))
    sizes = sizes.select("dim", "value", "tokens", (F.col("mass") / dims({d: r["mass"] or 1.0 for d, r in totals.items()})).alias("share"))
    keep = {d: keep_share * r["tokens"] for d, r in totals.items()}
    scale = dict(keep)
    for _ in range(FILLS):
        full = F.col("share") * dims(scale) >= F.col("tokens")
        sums = sizes.groupBy("dim").agg(F.sum(F.when(full, F.col("tokens")).otherwise(0.0)).alias("full"), F.sum(F.when(full, 0.0).otherwise(F.col("share"))).alias("rest")).collect()  # three rows
        new = {r["dim"]: (keep[r["dim"]] - r["full"]) / r["rest"] if r["rest"] > 0 else scale[r["dim"]] for r in sums}
        if new == scale:
            break
        scale = new
    return cut(sizes.withColumn("target", F.least("tokens", F.col("share") * dims(scale))))


def rake(cells: DataFrame, goal: DataFrame, keep_share: float, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[DataFrame, float]:
    """cells (source, lang, topic, tokens) with `probability`, and the largest miss of the last round, as a share of the kept tokens."""
    now = cells.withColumn("probability", F.lit(keep_share))
    for d in DIMENSIONS:
        now = now.join(goal.where(F.col("dim") == d).select(F.col("value").alias(d), F.col("target").alias(f"to_{d}")), d)
    now, miss = cut(now), 0.0
    kept = float(goal.where(F.col("dim") == DIMENSIONS[0]).agg(F.sum("target")).first()[0] or 0) or 1.0
    few = now.count() <= TASK_CELLS
    done = 0
    while done < rounds:
        if few:
            steps = min(TASK_ROUNDS, rounds - done)
            now = cut(_rounds_in_a_task(now.coalesce(1), kept, steps, tolerance))
        else:
            steps = 1
            now = cut(_round(now, kept, _joined))
        done += steps
        miss = float(now.agg(F.max("miss")).first()[0] or 0)
        now = now.drop("miss")
        if miss <= tolerance:
            break
    return now.select(*DIMENSIONS, "tokens", "probability"), miss


def _joined(now: DataFrame, dim: str) -> DataFrame:
    """`have`: the tokens expected of each cell's value, by partial sums."""
    return now.join(now.groupBy(dim).agg(F.sum(F.col("tokens") * F.col("probability")).alias("have")), dim)


def _windowed(now: DataFrame, dim: str) -> DataFrame:
    """The same for cells in one partition, where a window needs no exchange."""
    return now.withColumn("have", F.sum(F.col("tokens") * F.col("probability")).over(Window.partitionBy(dim)))


def _round(now: DataFrame, kept: float, have: Callable) -> DataFrame:
    """Every dimension scaled once, with `miss`: the largest miss that a cell's values had."""
    now = now.withColumn("miss", F.lit(0.0))
    for d in DIMENSIONS:
        now = have(now, d).withColumn("miss", F.greatest("miss", F.abs(F.col("have") - F.col(f"to_{d}")) / kept))
        factor = F.when(F.col("have") > 0, F.col(f"to_{d}") / F.col("have")).otherwise(1.0)
        now = now.withColumn("probability", F.least(F.lit(1.0), F.col("probability") * factor)).drop("have")
    return now


def _rounds_in_a_task(now: DataFrame, kept: float, steps: int, tolerance: float) -> DataFrame:
    """Several rounds of one partition in one job; rounds after the one that settles change nothing."""
    now = now.withColumn("last", F.lit(float("inf")))
    for _ in range(steps):
        now = _round(now.withColumn("before", F.col("probability")), kept, _windowed)
        over = F.col("last") <= tolerance
        now = now.withColumn("probability", F.when(over, F.col("before")).otherwise(F.col("probability")))
        now = now.withColumn("last", F.when(over, F.col("last")).otherwise(F.max("miss").over(Window.partitionBy()))).drop("before", "miss")
    return now.withColumnRenamed("last", "miss")


def uniform(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the key: 32 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _raked(rows: DataFrame, keep_share: float = KEEP_SHARE, temperature: float = TEMPERATURE, targets: dict | None = None, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame, float]:
    cells = cut(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")))
    goal = goals(cells, keep_share, temperature, targets)
    raked, miss = rake(cells, goal, keep_share, rounds)
    some = F.col("tokens") > 0
    raked = raked.select(*DIMENSIONS, "tokens", F.when(some, F.col("probability") / keep_share).otherwise(1.0).alias("weight"), F.when(some, F.col("probability")).otherwise(1.0).alias("probability"))
    return cut(raked), goal, miss


def cell_probabilities(rows: DataFrame, **options) -> DataFrame:
    """source, lang, topic, weight (relative to KEEP_SHARE), probability of every cell of the described rows."""
    return _raked(rows, **options)[0].drop("tokens")


def marginals(docs: DataFrame, rule: Callable = topic, **options) -> tuple[DataFrame, float]:
    """dim, value, tokens, share (asked), target and expected (tokens kept) of every value; and the largest miss of the last round."""
    raked, goal, miss = _raked(described(docs, rule), **options)
    met = [raked.groupBy(F.lit(d).alias("dim"), F.col(d).alias("value")).agg(F.sum(F.col("tokens") * F.col("probability")).alias("expected")) for d in DIMENSIONS]
    return goal.join(met[0].unionByName(met[1]).unionByName(met[2]), ["dim", "value"]), miss


def probabilities(docs: DataFrame, rule: Callable = topic, **options) -> DataFrame:
    """doc_id, source, lang, topic, tokens, weight, probability, kept of every row."""
    rows = described(docs, rule)
    out = rows.join(cell_probabilities(rows, **options), list(DIMENSIONS))
    return out.select("doc_id", *DIMENSIONS, "tokens", "weight", "probability", (uniform(F.col("doc_id")) < F.col("probability")).alias("kept"))


def sample(docs: DataFrame, rule: Callable = topic, **options) -> DataFrame:
    """The kept documents with their columns as they are."""
    free = lambda stem: next(f"{stem}{i}" for i in range(len(docs.columns) + 1) if f"{stem}{i}" not in docs.columns)
    names, chance = {d: free(f"__{d}") for d in DIMENSIONS}, free("__chance")
    ready = cell_probabilities(described(docs, rule), **options)
    ready = ready.select(*[F.col(d).alias(names[d]) for d in DIMENSIONS], F.col("probability").alias(chance))
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    own = {d: F.coalesce(docs[d].cast("string"), F.lit("(none)")) for d in ("source", "lang")}
    own["topic"] = F.coalesce(rule(tokens(text), lines), F.lit("(none)"))
    match = (own["source"] == ready[names["source"]]) & (own["lang"] == ready[names["lang"]]) & (own["topic"] == ready[names["topic"]])
    return docs.join(ready, match).where(uniform(docs["doc_id"]) < F.col(chance)).select(*[docs[c] for c in docs.columns])
