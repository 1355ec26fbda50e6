"""Fixed values.

These must equal the values used by the original card-rewards jobs for the
results to agree: tier labels, the reward unit of each card type id, the
production card-type -> reward-type map, the default conversion rates, the
home currency and the reject texts. They are plain data, kept together here.
"""

# ---- fixed values (must match the original jobs) --------------------------
TIER_LABELS = ("Base reward", "Category reward", "Campaign reward")

# reward unit per card type id 1..4 (ids outside 1..4 have no unit)
REWARD_UNITS = {1: "cashback", 2: "miles", 3: "miles", 4: "points"}

# card type id whose rate is shown as a percentage (rate * 100)
PERCENT_CARD_TYPE_ID = 1

# production card-type name -> reward type map
REWARD_TYPE_MAP = {
    "scis_shopping": "points",
    "scis_freedom": "cashback",
    "scis_platinummiles": "miles",
    "scis_premiummiles": "miles",
}

# default conversion rates into the home currency
CURRENCY_RATES = {"USD": "1.35", "SGD": "1"}
HOME_CURRENCY = "SGD"

# reject texts
R_MCC_EMPTY = "MCC is empty!"
R_TXID_EMPTY = "Transaction ID is empty!"
R_DUPLICATE = "Duplicate rows"
R_CARD_TYPE = "Card type not registered in DB!"
R_NOT_IN_RATES = " is not in currency mapping!"          # prefixed by the currency
R_DATE_SHAPE = "Date format should be yyyy-mm-dd: "      # followed by the date
R_ERROR = "Error in processing: "                         # followed by the field
EXCLUSION_REMARK = "No reward due to exclusion - "        # followed by the mcc
R_NO_CARD_TYPE_ID = "No card type ID detected!"
# ---------------------------------------------------------------------------
