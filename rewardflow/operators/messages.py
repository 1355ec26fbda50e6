"""K7: reward messages, one per matched tier (one zero-reward message for an
excluded mcc), with a stable key so a re-run can be de-duplicated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import MONEY
from .rules import round_money

MESSAGE_FIELDS = ("tenant", "transactionId", "transactionDate", "cardId", "merchant", "mcc",
                  "currency", "amount", "rewardAmount", "remarks")


def to_messages(result: DataFrame, tenant: str) -> DataFrame:
    """Accepted rows -> message rows. The amount is the original, unconverted
    value; the reward is rounded to 2 places."""
    def tier(name: str, reward: str, remark: str):
        return F.struct(F.lit(name).alias("tier"), F.col(reward).alias("reward"),
                        F.col(remark).alias("remarks"))

    tiers = F.array(tier("base", "rewardAmountBase", "remark_base"),
                    tier("category", "rewardAmountCat", "remark_cat"),
                    tier("campaign", "rewardAmountCampaign", "remark_camp"))
    excluded = F.array(F.struct(F.lit("base").alias("tier"), F.lit(0).cast(MONEY).alias("reward"),
                                F.col("remark").alias("remarks")))
    acc = result.where(F.col("reject_reason").isNull() & F.col("amount_num").isNotNull())
    # unmatched tiers have an empty remark and send nothing
    m = (acc.select("*", F.explode(F.when(F.col("excluded"), excluded).otherwise(tiers)).alias("_m"))
            .where(F.col("_m.remarks") != ""))
    ten = F.upper(F.lit(tenant))
    return m.select(
        ten.alias("tenant"),
        F.col("transaction_id").alias("transactionId"),
        F.col("transaction_date").alias("transactionDate"),
        F.col("card_id").alias("cardId"),
        F.col("merchant"),
        F.col("mcc_int").alias("mcc"),
        F.col("currency"),
        F.col("amount_num").alias("amount"),
        round_money(F.col("_m.reward")).alias("rewardAmount"),
        F.col("_m.remarks").alias("remarks"),
        F.col("_m.tier").alias("tier"),
        F.sha2(F.concat_ws("|", ten, F.col("transaction_id"), F.col("_m.tier")), 256).alias("messageKey"),
    )


def message_json(messages: DataFrame) -> DataFrame:
    """(messageKey, body): the JSON text a queue writer sends. Amounts are
    written as numbers."""
    body = F.struct(*[F.col(c).cast("double").alias(c) if c in ("amount", "rewardAmount")
                      else F.col(c) for c in MESSAGE_FIELDS])
    return messages.select("messageKey", F.to_json(body, {"ignoreNullFields": "false"}).alias("body"))
