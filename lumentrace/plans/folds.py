"""Sequential folds and model flows, which SQL cannot express; the tests hold them against plain loops."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumentrace.functions.salvage import salvage_batch
from lumentrace.operators import flows
from lumentrace.plans.tables import Book, table
from lumentrace.streaming import folds

book = Book()


@book.add("event_job_fsm")
def event_job_fsm(spark, sf):
    """The stage machine of each user over its events as job events."""
    names = {"view": "submit", "click": "job:RUNNING", "purchase": "job:SUCCEEDED", "error": "job:FAILED"}
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", F.coalesce(F.create_map(*pairs)[F.col("event_type")], F.lit("resume")).alias("event"))
    return folds.stage_fold(e, "user_id", ["ts", "event_id"], "event")


@book.add("event_aimd_fold")
def event_aimd_fold(spark, sf):
    """The adaptive limit of each user over its successes and congestions."""
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", (F.col("event_type") != "error").alias("ok"), ((F.col("event_type") == "error") & (F.col("value") > 50)).alias("congested"))
    return folds.limit_fold(e, "user_id", ["ts", "event_id"], "ok", "congested")


@book.add("stage_calls")
def stage_calls(spark, sf):
    """Model calls with the offline provider for every turn, with failure codes and usage."""
    c = table(spark, sf, "conversations")
    req = c.select(F.col("conv_id").cast("string").alias("clip_id"), F.col("turn").cast("int").alias("call_index"), F.to_json(F.struct("role", "text")).alias("request"))
    return flows.call_stage(req, "annotation", flows.offline)


@book.add(
    "salvage_json",
    "SELECT conv_id, turn, role, sha256(coalesce(text, '')) AS text_sha, CASE WHEN conv_id % 2 = 0 THEN 1 ELSE 0 END AS left_over FROM conversations",
)
def salvage_json(spark, sf):
    """Turns as JSON that is cut off behind their texts, within a further list: what was whole comes back, with the items of the list that had ended."""
    c = table(spark, sf, "conversations").withColumn("text", F.coalesce("text", F.lit("")))
    whole = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    # the list goes on with the text again, which has no end
    again = F.substring(F.to_json(F.struct(F.col("text").alias("t"))), 6, 30)
    cut = F.concat(F.expr("substring(to_json(struct(conv_id, turn, role, text)), 1, length(to_json(struct(conv_id, turn, role, text))) - 1)"), F.lit(', "left": ['), F.when(F.col("conv_id") % 2 == 0, F.lit('"one", ')).otherwise(""), F.regexp_replace(again, r'\\?"\}?$', ""))
    found = c.select("conv_id", "turn", F.from_json(F.pandas_udf(salvage_batch, "string")(F.when(whole.isNotNull(), cut)), "role STRING, text STRING, left ARRAY<STRING>").alias("r"))
    return found.select("conv_id", "turn", "r.role", F.sha2("r.text", 256).alias("text_sha"), F.size("r.left").alias("left_over"))
