"""Token statistics, taxonomy and the data card."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

THINK = r"(?s)<think>(.*?)</think>"


def turn_counts(role: Column, text: Column, reasoning: Column | None = None) -> tuple[Column, Column, Column]:
    """(prompt tokens, reasoning tokens, tool turns) of a turn; tagged thoughts count only where no reasoning is given."""
    tagged = F.array_join(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(THINK), F.lit(1)), "\n")
    thought = tagged if reasoning is None else F.when(F.coalesce(reasoning, F.lit("")) != "", reasoning).otherwise(tagged)
    prompt = F.when(role.isin("user", "system"), T.token_estimate(text)).otherwise(0)
    return prompt.cast("long"), F.when((role == "assistant") & (thought != ""), T.token_estimate(thought)).otherwise(0).cast("long"), F.when(role.isin("tool", "function"), 1).otherwise(0).cast("long")


def record_counts(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    p, r, t = turn_counts(F.col("role"), F.col("text"))
    return turns.groupBy(key).agg(F.sum(p).alias("prompt_tokens"), F.sum(r).alias("reasoning_tokens"), F.sum(t).alias("tool_turns"))


def token_statistics(records: DataFrame) -> DataFrame:
    """One row: count, and of each measure its sum, mean (2 digits), least and greatest; zeros for no records."""
    out = [F.count("*").alias("n_records")]
    for c in ("prompt_tokens", "reasoning_tokens", "tool_turns"):
        zero = lambda x: F.coalesce(x, F.lit(0))
        out += [zero(F.sum(c)).alias(f"{c}_total"), F.coalesce(F.round(F.avg(c), 2), F.lit(0.0)).alias(f"{c}_mean"), zero(F.min(c)).alias(f"{c}_min"), zero(F.max(c)).alias(f"{c}_max")]
    return records.agg(*out)


def taxonomy(df: DataFrame, **columns: str) -> DataFrame:
    """Distinct tags ``prefix:value``, sorted; ``columns`` maps prefixes to columns."""
    tags = F.array(*[F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.concat(F.lit(f"{p}:"), F.col(c).cast("string"))) for p, c in columns.items()])
    return df.select(F.explode(F.array_compact(tags)).alias("tag")).distinct().orderBy("tag")


def build_card(name: str, statistics: DataFrame, tags: DataFrame, provenance: dict | None = None, max_tags: int = 1000) -> dict:
    """The card as a document: the one row of statistics, tags, hashes of where the data come from, and its sections. Of more than
    ``max_tags`` tags the first are listed; ``n_tags`` counts all, and ``write_card`` can put all beside the card."""
    stats = statistics.first().asDict()
    body = {"name": name, "statistics": stats, "taxonomy": [r["tag"] for r in tags.limit(max_tags).collect()], "n_tags": tags.count(), "provenance": provenance or {}}
    body["sections"] = {
        "motivation": f"{name} gathers curated traces for training and evaluation.",
        "composition": f"{stats['n_records']} records with {stats['prompt_tokens_total']} prompt and {stats['reasoning_tokens_total']} reasoning tokens.",
        "collection": "Records come from sealed runs; their digests are listed under provenance.",
        "preprocessing": "Personal data and secrets were redacted, licences gated, benchmark overlaps and duplicates removed.",
        "uses": "Supervised training with loss on assistant turns, and paired evaluation.",
        "distribution": "Terms follow the rights recorded for each source.",
        "maintenance": "A withdrawn record is listed in the ledger; lots are never changed in place.",
    }
    return body


def render_markdown(card: dict) -> str:
    lines = [f"# {card['name']}", "", "| Measure | Value |", "|---|---|", *(f"| {k} | {v} |" for k, v in card["statistics"].items()), "", "## Taxonomy", "", *(f"- {t}" for t in card["taxonomy"]), ""]
    if len(card["taxonomy"]) < card["n_tags"]:
        lines += [f"The first {len(card['taxonomy'])} of {card['n_tags']} tags.", ""]
    for title, text in card["sections"].items():
        lines += [f"## {title.capitalize()}", "", text, ""]
    return "\n".join([*lines, "## Provenance", "", *(f"- {k}: `{v}`" for k, v in card["provenance"].items())]) + "\n"


def write_card(card: dict, folder: str, tags: DataFrame | None = None, table: str | None = None) -> None:
    """datacard.json and datacard.md, by the driver: a card is a page long, whatever the data. All ``tags`` go to ``table``, a path of Spark's;
    a card that lists only some is not written without."""
    if tags is not None and table is not None:
        tags.write.mode("overwrite").parquet(table)
    elif len(card["taxonomy"]) < card["n_tags"]:
        raise ValueError("the card lists only some of its tags: name the tags and a table for all")
    Path(folder).mkdir(parents=True, exist_ok=True)
    Path(folder, "datacard.json").write_text(json.dumps(card, sort_keys=True, indent=2, ensure_ascii=False) + "\n", encoding="utf-8")
    Path(folder, "datacard.md").write_text(render_markdown(card), encoding="utf-8")
