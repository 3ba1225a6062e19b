"""Queries of paired evaluation (``labels``: quality as before, not toxic as after) and of ``events``."""

from pyspark.sql import functions as F

from ..operators import assay as A
from ..operators import events as E
from .catalog import query, read

_CASES = "WITH cases AS (SELECT l.doc_id::VARCHAR AS case_id, d.lang AS task, quality = 1 AS base_passed, toxic = 0 AS tuned_passed, NULL::BOOLEAN AS base_recovered, CASE WHEN toxic = 1 THEN quality = 1 END AS tuned_recovered, (n_chars % 7)::INT AS base_turns, (n_chars % 5)::INT AS tuned_turns FROM labels l JOIN documents d USING (doc_id)), t AS (SELECT *, CASE WHEN tuned_passed AND NOT base_passed THEN 'WIN' WHEN base_passed AND NOT tuned_passed THEN 'LOSS' WHEN base_passed THEN 'MAINTAINED_PASS' ELSE 'UNRESOLVED_FAIL' END AS tr FROM cases)"


def label_cases(spark, d):
    rows = read(spark, d, "labels").join(read(spark, d, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    null = F.lit(None)
    return rows.select(F.col("doc_id").cast("string").alias("case_id"), F.col("lang").alias("task"), (F.col("quality") == 1).alias("base_passed"), (F.col("toxic") == 0).alias("tuned_passed"), null.cast("boolean").alias("base_recovered"), F.when(F.col("toxic") == 1, F.col("quality") == 1).alias("tuned_recovered"), F.lit(4).alias("base_tools"), (F.col("quality") + 2).alias("base_tools_valid"), F.lit(4).alias("tuned_tools"), (4 - F.col("toxic")).alias("tuned_tools_valid"), (F.col("n_chars") % 7).cast("int").alias("base_turns"), (F.col("n_chars") % 5).cast("int").alias("tuned_turns"), F.col("n_chars").cast("int").alias("base_tokens"), (F.col("n_chars") / 2).cast("int").alias("tuned_tokens"))


@query("assay_transitions", _CASES + " SELECT tr AS transition, count(*) AS n FROM t GROUP BY tr")
def assay_transitions(spark, d):
    return label_cases(spark, d).groupBy(A.transition(F.col("base_passed"), F.col("tuned_passed")).alias("transition")).agg(F.count("*").alias("n"))


@query("assay_totals", _CASES + """ SELECT count(*) AS n_cases, count(*) FILTER (base_passed) AS base_pass, count(*) FILTER (tuned_passed) AS tuned_pass, round(100.0::DOUBLE * count(*) FILTER (base_passed) / count(*), 2) AS base_rate, round(100.0::DOUBLE * count(*) FILTER (tuned_passed) / count(*), 2) AS tuned_rate,
count(*) FILTER (tr = 'WIN') AS wins, count(*) FILTER (tr = 'LOSS') AS losses, count(*) FILTER (tr = 'MAINTAINED_PASS') AS maintained, count(*) FILTER (tr = 'UNRESOLVED_FAIL') AS unresolved FROM t""")
def assay_totals(spark, d):
    return A.totals(label_cases(spark, d))


@query("assay_mcnemar", _CASES + """, a AS (SELECT task, count(*) FILTER (tr = 'WIN') AS b, count(*) FILTER (tr = 'LOSS') AS c FROM t GROUP BY task), k AS (SELECT task, b, c, unnest(range(0, least(b, c) + 1)) AS i FROM a),
lg AS (SELECT task, b, c, sum(exp(lgamma(b + c + 1) - lgamma(i + 1) - lgamma(b + c - i + 1) - (b + c) * ln(2))) AS tail FROM k GROUP BY ALL)
SELECT task, b AS wins, c AS losses, round(CASE WHEN b = c THEN 1.0 ELSE least(1.0, 2 * tail) END, 6)::DOUBLE AS p_value FROM lg""")
def assay_mcnemar(spark, d):
    t = A.transition(F.col("base_passed"), F.col("tuned_passed"))
    n = label_cases(spark, d).groupBy("task").agg(F.count_if(t == "WIN").alias("wins"), F.count_if(t == "LOSS").alias("losses"))
    return n.withColumn("p_value", F.round(A.mcnemar_column(F.col("wins"), F.col("losses")), 6))


@query("assay_task_breakdown", _CASES + """ SELECT task, count(*) AS n_cases, round(100.0::DOUBLE * count(*) FILTER (base_passed) / count(*), 2) AS base_rate, round(100.0::DOUBLE * count(*) FILTER (tuned_passed) / count(*), 2) AS tuned_rate, count(*) FILTER (tr = 'WIN') AS wins, count(*) FILTER (tr = 'LOSS') AS losses,
round(avg(base_turns - tuned_turns), 2) AS turns_saved, round(100.0::DOUBLE * count(*) FILTER (tuned_recovered) / nullif(count(tuned_recovered), 0), 2) AS tuned_recovery FROM t GROUP BY task""")
def assay_task_breakdown(spark, d):
    return A.by_task(label_cases(spark, d)).drop("base_recovery", "base_tokens", "tuned_tokens")


@query("assay_paired_turns", _CASES + " SELECT count(*) AS n, round(avg(base_turns - tuned_turns), 9) AS mean_saved, round(stddev_samp(base_turns - tuned_turns), 9) AS sd FROM t")
def assay_paired_turns(spark, d):
    return A.turns_difference(label_cases(spark, d)).withColumns({c: F.round(c, 9) for c in ("mean_saved", "sd")})


@query("event_chain_lag", """WITH e AS (SELECT *, lag(event_id) OVER w AS prev_id, lag(ts) OVER w AS prev_ts, row_number() OVER w - 1 AS idx FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, event_id, idx AS index, coalesce(prev_id, -1) AS prev_id, sha256(props) AS payload_sha256, coalesce(prev_ts <= ts, true) AS in_order FROM e""")
def event_chain_lag(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return read(spark, d, "events").select("user_id", "event_id", (F.row_number().over(w) - 1).cast("long").alias("index"), F.coalesce(F.lag("event_id").over(w), F.lit(-1)).alias("prev_id"), F.sha2("props", 256).alias("payload_sha256"), F.coalesce(F.lag("ts").over(w) <= F.col("ts"), F.lit(True)).alias("in_order"))


@query("request_next_action", """SELECT user_id, event_id AS request_id, coalesce((SELECT min_by(a.event_id, (a.ts, a.event_id)) FROM events a WHERE a.user_id = e.user_id AND a.event_type = 'purchase' AND (a.ts, a.event_id) > (e.ts, e.event_id)), -1) AS action_id FROM events e WHERE event_type = 'click'""")
def request_next_action(spark, d):
    return E.next_action(read(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "click", F.col("event_type") == "purchase", "event_id").na.fill(-1, ["action_id"])


_LEAD = "WITH e AS (SELECT user_id, event_id, event_type, lead(event_id) OVER w AS nid, lead(event_type) OVER w AS ntype, row_number() OVER w AS rn FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"


@query("preference_pairs", _LEAD + " SELECT user_id, event_id AS first_id, nid AS second_id FROM e WHERE event_type = 'error' AND ntype IS NOT NULL AND ntype <> 'error'")
def preference_pairs(spark, d):
    return E.lead_pairs(read(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error", F.col("event_type") != "error", "event_id")


@query("recovery_pairs", _LEAD + " SELECT user_id, min_by(event_id, rn) AS first_id, min_by(nid, rn) AS second_id FROM e WHERE event_type = 'error' AND ntype = 'purchase' GROUP BY user_id")
def recovery_pairs(spark, d):
    return E.lead_pairs(read(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error", F.col("event_type") == "purchase", "event_id", one_per_run=True)


@query("structural_digest", """WITH e AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) SELECT user_id, count(*) AS n_events, sha256(string_agg(event_type, '>' ORDER BY r) FILTER (r <= 50)) AS structural_sha256 FROM e GROUP BY user_id""")
def structural_digest(spark, d):
    return E.structural_digest(read(spark, d, "events"), "user_id", ["ts", "event_id"])


@query("normalised_events", "SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS index, event_type, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp, props AS payload FROM events")
def normalised_events(spark, d):
    return E.normalise_events(read(spark, d, "events"), "user_id", ["ts", "event_id"])
