"""Explicit schemas: inputs are read with these, never inferred."""

from pyspark.sql import types as T

_S = T.StringType()

SPEND_COLUMNS = (
    "id", "transaction_id", "merchant", "mcc", "currency", "amount",
    "transaction_date", "card_id", "card_pan", "card_type",
)
SPEND_SCHEMA = T.StructType([T.StructField(c, _S, True) for c in SPEND_COLUMNS])

USER_COLUMNS = (
    "id", "first_name", "last_name", "email", "phone", "card_id",
    "card_pan", "card_type", "created_at",
)
USER_SCHEMA = T.StructType([T.StructField(c, _S, True) for c in USER_COLUMNS])

CARD_TYPE_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), True),
    T.StructField("name", _S, True),
    T.StructField("tenant", _S, True),
])

EXCLUSION_SCHEMA = T.StructType([
    T.StructField("card_type_id", T.IntegerType(), True),
    T.StructField("mcc_mcc", T.IntegerType(), True),
    T.StructField("tenant", _S, True),
])

RATE = T.DecimalType(10, 4)           # reward rates
CURRENCY_RATE = T.DecimalType(22, 14)  # conversion rates
AMOUNT = T.DecimalType(28, 10)        # amounts as read, not rounded to the currency
MONEY = T.DecimalType(24, 6)          # running amounts inside the engine
MONEY_OUT = T.DecimalType(24, 2)      # amounts leaving the engine: every MONEY value fits

RULE_SCHEMA = T.StructType([
    T.StructField("title", _S, True),
    T.StructField("card_type_id", T.IntegerType(), True),
    T.StructField("end_date", T.DateType(), True),
    T.StructField("is_active", T.BooleanType(), True),
    T.StructField("is_foreign", T.BooleanType(), True),
    T.StructField("min_dollar_spent", T.DecimalType(18, 2), True),
    T.StructField("merchant", _S, True),
    T.StructField("custom_category_name", _S, True),
    T.StructField("reward_rate", RATE, True),
])

CATEGORY_SCHEMA = T.StructType([
    T.StructField("name", _S, True),       # merchant pattern
    T.StructField("mcc", T.IntegerType(), True),
    T.StructField("merchant", _S, True),   # category label
])

RATE_SCHEMA = T.StructType([
    T.StructField("currency", _S, False),
    T.StructField("rate", CURRENCY_RATE, False),
])

# card DB / campaign DB upsert targets
CARD_CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_id", _S, True),
    T.StructField("email", _S, True),
    T.StructField("tenant", _S, True),
])
CARD_SCHEMA = T.StructType([
    T.StructField("card_id", _S, True),
    T.StructField("card_type", _S, True),
    T.StructField("reward_type", _S, True),
    T.StructField("tenant", _S, True),
    T.StructField("customer_id", _S, True),
])
CAMPAIGN_CUSTOMER_SCHEMA = T.StructType([
    T.StructField("email", _S, True),
    T.StructField("name", _S, True),
    T.StructField("phone_number", _S, True),
    T.StructField("card_type_id", T.IntegerType(), True),
])
