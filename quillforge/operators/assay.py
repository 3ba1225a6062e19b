"""Proof of lift: paired before/after evaluation.

Counting and pairing run as queries. The tests are closed forms over one aggregated row, so they run on the driver.
"""

from __future__ import annotations

import hashlib
import json
import math
from dataclasses import asdict, dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Z95 = 1.959963984540054
CASE = "case_id string, task string, base_passed boolean, tuned_passed boolean, base_recovered boolean, tuned_recovered boolean, base_tools int, base_tools_valid int, tuned_tools int, tuned_tools_valid int, base_turns int, tuned_turns int, base_tokens int, tuned_tokens int, base_latency_ms double, tuned_latency_ms double"


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


def mcnemar(b: int, c: int) -> float:
    """Two-sided p of the discordant counts: exact up to 1000 of them, else normal with a continuity correction."""
    n = b + c
    if n == 0 or b == c:
        return 1.0
    if n > 1000:
        return 2 * (1 - normal_cdf(max(0.0, abs(b - c) - 1) / math.sqrt(n)))
    return min(1.0, 2 * sum(math.comb(n, k) for k in range(min(b, c) + 1)) / 2**n)


def erfc_column(x: Column) -> Column:
    """The complementary error function of x >= 0: a power series up to 2.5, a continued fraction beyond."""
    zero = F.struct(x.alias("term"), x.alias("total"))
    up = lambda a, n: F.struct((-a["term"] * x * x / n).alias("term"), (a["total"] - a["term"] * x * x / n / (2 * n + 1)).alias("total"))
    series = 1 - 2 / math.sqrt(math.pi) * F.aggregate(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda n: n.cast("double")), zero, up, lambda a: a["total"])
    fraction = F.aggregate(F.transform(F.sequence(F.lit(80), F.lit(1), F.lit(-1)), lambda n: n.cast("double")), x, lambda a, n: x + n / 2 / a)
    return F.when(x < 2.5, series).otherwise(F.exp(-x * x) / math.sqrt(math.pi) / fraction)


def mcnemar_column(b: Column, c: Column) -> Column:
    """``mcnemar`` as a column. The largest term of the binomial tail is made of logarithms, so that it does not vanish; each term before follows from it."""
    n, k = (b + c).cast("double"), F.least(b, c)
    counts = F.when(k > 0, F.sequence(F.lit(1), k.cast("int"))).otherwise(F.expr("cast(array() as array<int>)"))
    log = F.aggregate(counts, n * math.log(0.5), lambda a, i: a + F.log((n - i + 1) / i))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))
    down = lambda a, i: F.struct((a["term"] * i / (n - i + 1)).alias("term"), (a["total"] + a["term"] * i / (n - i + 1)).alias("total"))
    tail = F.exp(log) * F.aggregate(F.reverse(counts), start, down, lambda a: a["total"])
    z = F.greatest(F.lit(0.0), F.abs(b - c) - 1) / F.sqrt(n)
    exact = F.least(F.lit(1.0), 2 * tail)
    return F.when((n == 0) | (b == c), 1.0).when(n > 1000, erfc_column(z / math.sqrt(2))).otherwise(exact)


def paired_ci(wins: int, losses: int, n: int) -> tuple[float, float]:
    """95 % interval, in points, of the difference of paired proportions."""
    if not n:
        return 0.0, 0.0
    d = (wins - losses) / n
    se = math.sqrt(max(0.0, (wins + losses) / n - d * d) / n)
    return tuple(round(100 * max(-1.0, min(1.0, d + s * Z95 * se)), 2) for s in (-1, 1))


def independent_ci(p1: float, n1: int, p2: float, n2: int) -> tuple[float, float]:
    if not n1 or not n2:
        return 0.0, 0.0
    se = math.sqrt(p1 * (1 - p1) / n1 + p2 * (1 - p2) / n2)
    return tuple(round(100 * max(-1.0, min(1.0, p2 - p1 + s * Z95 * se)), 2) for s in (-1, 1))


def t_cdf(t: float, df: int) -> float:
    """Student's t; by the normal from 30 degrees of freedom on, else with the usual variance-matching argument."""
    return normal_cdf(t) if df >= 30 else normal_cdf(t * (1 - 1 / (4 * df)) / math.sqrt(1 + t * t / (2 * df)))


def paired_t(mean: float, sd: float | None, n: int) -> tuple[float, float, float]:
    """(p, low, high) of a mean paired difference."""
    if n < 2:
        return 1.0, mean, mean
    se = (sd or 0.0) / math.sqrt(n)
    if se == 0:
        return (1.0 if mean == 0 else 0.0001), mean, mean
    return min(1.0, 2 * (1 - t_cdf(abs(mean / se), n - 1))), round(mean - Z95 * se, 2), round(mean + Z95 * se, 2)


def proportion_z(valid1: int, n1: int, valid2: int, n2: int) -> tuple[float, float, float]:
    """(percent before, percent after, p); a side without calls counts as all valid."""
    a, b = (100.0 * valid1 / n1 if n1 else 100.0), (100.0 * valid2 / n2 if n2 else 100.0)
    if not n1 or not n2:
        return a, b, 1.0
    pool = (valid1 + valid2) / (n1 + n2)
    se = max(1e-9, math.sqrt(pool * (1 - pool) * (1 / n1 + 1 / n2)))
    return a, b, min(1.0, 2 * (1 - normal_cdf(abs(b - a) / 100 / se)))


def transition(base: Column, tuned: Column) -> Column:
    return F.when(tuned & ~base, "WIN").when(base & ~tuned, "LOSS").when(base & tuned, "MAINTAINED_PASS").otherwise("UNRESOLVED_FAIL")


def receipts_to_cases(receipts: DataFrame) -> DataFrame:
    """(case_id, task, passed, recovered, tools, tools_valid, turns, ord) of receipts given as JSON texts with a place ``ord``.

    A case without any id is case_%04d by its place; a missing count of valid calls is the count of calls; without a validation a
    receipt passes if it was scored."""
    v = F.try_parse_json("json")
    get = lambda kind, *paths: F.coalesce(*[F.try_variant_get(v, p, kind) for p in paths])
    tools = F.coalesce(get("int", "$.tool_calls_total", "$.calls_used"), F.lit(0))
    ident = F.coalesce(F.nullif(get("string", "$.case.id", "$.case_id", "$.id"), F.lit("")), F.format_string("case_%04d", F.col("ord")))
    passed = F.coalesce(get("boolean", "$.validation.accepted", "$.passed"), get("string", "$.status") == "SCORED", F.lit(False))
    return receipts.select(ident.alias("case_id"), F.coalesce(get("string", "$.case.task", "$.task"), F.lit("unknown")).alias("task"), passed.alias("passed"), get("boolean", "$.validation.recovery_success", "$.recovered").alias("recovered"), tools.alias("tools"), F.coalesce(get("int", "$.tool_calls_valid"), tools).alias("tools_valid"), F.coalesce(get("int", "$.turns", "$.calls_used"), F.lit(0)).alias("turns"), "ord")


def pair(base: DataFrame, tuned: DataFrame) -> DataFrame:
    """Cases of both sides by id: of tuned duplicates the last counts, base duplicates stay, and what has no partner goes."""
    last = tuned.withColumn("_r", F.row_number().over(Window.partitionBy("case_id").orderBy(F.desc("ord")))).where("_r = 1")
    side = lambda df, p: df.select("case_id", *[F.col(c).alias(f"{p}_{c}") for c in ("passed", "recovered", "tools", "tools_valid", "turns")])
    return side(base, "base").join(base.select("case_id", "ord", "task"), "case_id").dropDuplicates(["case_id", "ord"]).join(side(last, "tuned"), "case_id")


def cases_from_aggregates(base: DataFrame, tuned: DataFrame) -> DataFrame:
    """Cases made of task aggregates (task, attempted, accuracy) of both sides: tasks of either; a missing side has passed none."""
    both = base.alias("b").join(tuned.alias("t"), "task", "full")
    n = F.greatest(F.coalesce("b.attempted", F.lit(0)), F.coalesce("t.attempted", F.lit(0)))
    passed = lambda s: F.round(F.coalesce(F.col(f"{s}.accuracy"), F.lit(0.0)) * n).cast("int")
    rows = both.where(n > 0).select("task", passed("b").alias("bp"), passed("t").alias("tp"), F.explode(F.sequence(F.lit(1), n.cast("int"))).alias("k"))
    return rows.select(F.concat_ws("_", "task", F.format_string("%04d", "k")).alias("case_id"), "task", (F.col("k") <= F.col("bp")).alias("base_passed"), (F.col("k") <= F.col("tp")).alias("tuned_passed"))


def totals(cases: DataFrame) -> DataFrame:
    """One row of counts and rates."""
    n, t = F.count("*"), transition(F.col("base_passed"), F.col("tuned_passed"))
    pct = lambda x: F.when(n > 0, F.round(100.0 * x / n, 2)).otherwise(0.0)
    c = lambda s: F.count_if(t == s)
    return cases.agg(n.alias("n_cases"), F.count_if("base_passed").alias("base_pass"), F.count_if("tuned_passed").alias("tuned_pass"), pct(F.count_if("base_passed")).alias("base_rate"), pct(F.count_if("tuned_passed")).alias("tuned_rate"), c("WIN").alias("wins"), c("LOSS").alias("losses"), c("MAINTAINED_PASS").alias("maintained"), c("UNRESOLVED_FAIL").alias("unresolved"))


def by_task(cases: DataFrame) -> DataFrame:
    """Counts and rates of each task; recovery is null where no case of the task has any."""
    n, t = F.count("*"), transition(F.col("base_passed"), F.col("tuned_passed"))
    rec = [F.coalesce(F.col(c), F.lit(False)) for c in ("base_recovered", "tuned_recovered")]
    seen = F.col("base_recovered").isNotNull() | F.col("tuned_recovered").isNotNull()
    rate = lambda x: F.when(F.count_if(seen) > 0, F.round(100.0 * F.count_if(seen & x) / F.count_if(seen), 2))
    return cases.groupBy("task").agg(n.alias("n_cases"), F.round(100.0 * F.count_if("base_passed") / n, 2).alias("base_rate"), F.round(100.0 * F.count_if("tuned_passed") / n, 2).alias("tuned_rate"), F.count_if(t == "WIN").alias("wins"), F.count_if(t == "LOSS").alias("losses"), F.round(F.avg(F.col("base_turns") - F.col("tuned_turns")), 2).alias("turns_saved"), rate(rec[0]).alias("base_recovery"), rate(rec[1]).alias("tuned_recovery"), F.round(F.avg("base_tokens"), 2).alias("base_tokens"), F.round(F.avg("tuned_tokens"), 2).alias("tuned_tokens"))


def turns_difference(cases: DataFrame) -> DataFrame:
    d = F.col("base_turns") - F.col("tuned_turns")
    return cases.agg(F.count(d).alias("n"), F.avg(d).alias("mean_saved"), F.stddev_samp(d).alias("sd"))


@dataclass
class Report:
    n_cases: int
    base_rate: float
    tuned_rate: float
    gain: float
    gain_ci95_z: tuple[float, float]
    wins: int
    losses: int
    maintained: int
    unresolved: int
    win_loss_ratio: float | None
    p_value: float
    turns_saved: float
    turns_p: float
    tool_validity_before: float
    tool_validity_after: float
    tool_p: float
    recovery_before: float | None
    recovery_after: float | None
    tokens_saved_pct: float | None
    verdict: str
    seal_sha256: str = ""

    def sealed(self) -> Report:
        body = asdict(self) | {"seal_sha256": ""}
        self.seal_sha256 = hashlib.sha256(json.dumps(body, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
        return self

    def markdown(self) -> str:
        return "\n".join([f"# Lift report: {self.verdict}", "", "| Measure | Value |", "|---|---|", *(f"| {k} | {v} |" for k, v in asdict(self).items())]) + "\n"

    def save(self, folder: str) -> None:
        """report.json and report.md, each written aside and renamed."""
        import os

        Path(folder).mkdir(parents=True, exist_ok=True)
        for name, text in (("report.json", json.dumps(asdict(self), sort_keys=True, indent=2) + "\n"), ("report.md", self.markdown())):
            aside = Path(folder, f".{name}.part")
            with aside.open("w", encoding="utf-8") as f:
                f.write(text)
                f.flush()
                os.fsync(f.fileno())
            os.replace(aside, Path(folder, name))


def verdict(n: int, gain: float, wins: int, losses: int, p: float, turns_saved: float, tool_gain: float) -> str:
    if not n:
        return "INSUFFICIENT"
    if gain < 0 or losses / n > 0.1:
        return "REGRESSION"
    if gain >= 5 and (p < 0.05 or wins >= 2 * max(1, losses)):
        return "PROVEN"
    return "QUALIFIED" if gain > 0 or turns_saved > 0.5 or tool_gain > 10 else "INSUFFICIENT"


def report(cases: DataFrame) -> Report:
    """The whole report of paired cases (CASE): one aggregation, then closed forms."""
    d, seen = F.col("base_turns") - F.col("tuned_turns"), F.col("base_recovered").isNotNull() | F.col("tuned_recovered").isNotNull()
    row = totals(cases).crossJoin(F.broadcast(cases.agg(F.count(d).alias("nd"), F.avg(d).alias("md"), F.stddev_samp(d).alias("sd"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("base_tools", "base_tools_valid", "tuned_tools", "tuned_tools_valid")], F.count_if(seen).alias("nr"), F.count_if(seen & F.coalesce("base_recovered", F.lit(False))).alias("br"), F.count_if(seen & F.coalesce("tuned_recovered", F.lit(False))).alias("tr"), F.avg("base_tokens").alias("bt"), F.avg("tuned_tokens").alias("tt")))).first()
    n, gain = row.n_cases, round(row.tuned_rate - row.base_rate, 2)
    before, after, tool_p = proportion_z(row.base_tools_valid, row.base_tools, row.tuned_tools_valid, row.tuned_tools)
    p, (turns_p, _, _) = mcnemar(row.wins, row.losses), paired_t(row.md or 0.0, row.sd, row.nd)
    saved = round(row.md or 0.0, 2)
    rate = lambda k: round(100 * k / row.nr, 2) if row.nr else None
    return Report(n, row.base_rate, row.tuned_rate, gain, paired_ci(row.wins, row.losses, n), row.wins, row.losses, row.maintained, row.unresolved, row.wins / row.losses if row.losses else None, p, saved, turns_p, round(before, 2), round(after, 2), tool_p, rate(row.br), rate(row.tr), round(100 * (row.bt - row.tt) / row.bt, 2) if row.bt and row.tt is not None else None, verdict(n, gain, row.wins, row.losses, p, saved, after - before)).sealed()
