"""Text helpers: remarks, masks, paths and dates, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import PERCENT_CARD_TYPE_ID, REWARD_UNITS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_literal(d: dict) -> Column:
    """A MapType literal from a small fixed dict."""
    items = []
    for k, v in d.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def unit_for(card_type_id: Column | str) -> Column:
    """Reward unit of a card type id; NULL when the id has none."""
    return F.try_element_at(map_literal(REWARD_UNITS), _col(card_type_id))


def rate_text(rate: Column | str, card_type_id: Column | str) -> Column:
    """Rate as shown in a remark: percent for the percent card type, 2 places,
    printed like a float ('5.0', '1.25')."""
    rate, ct = _col(rate), _col(card_type_id)
    shown = F.when(ct == PERCENT_CARD_TYPE_ID, rate * 100).otherwise(rate)
    return F.round(shown, 2).cast("double").cast("string")


def tier_remark(label: str, rate: Column, card_type_id: Column, unit: Column) -> Column:
    """'<label> giving <rate> <unit>/SGD' when the tier matched, else ''."""
    text = F.concat(F.lit(f"{label} giving "), rate_text(rate, card_type_id),
                    F.lit(" "), unit, F.lit("/SGD"))
    return F.when(rate.isNotNull(), text).otherwise(F.lit(""))


def mask_pan(pan: Column | str) -> Column:
    """Card number reduced to its last four digits."""
    pan = _col(pan)
    return F.when(pan.isNull(), None).otherwise(
        F.concat(F.lit("****"), F.substring(pan, -4, 4)))


def base_name(path: Column | str) -> Column:
    """Last path segment: 'a/b/c.csv' -> 'c.csv'."""
    return F.element_at(F.split(_col(path), "/"), -1)


def reject_folder(path: Column | str) -> Column:
    """Reject folder of an object key: 'x/in/2021/f.csv' -> 'error/2021/'.

    A key without a parent folder has none (NULL)."""
    parts = F.split(_col(path), "/")
    parent = F.when(F.size(parts) >= 2, F.element_at(parts, -2))
    return F.concat(F.lit("error/"), parent, F.lit("/"))


def normalise_date(d: Column | str) -> Column:
    """'a/b/c' -> 'a-bb-cc': a one-character second or third part gets a
    leading '0'; part order is kept. Other text is returned unchanged."""
    d = _col(d)
    parts = F.split(d, "/")

    def pad(p: Column) -> Column:
        return F.when(F.length(p) == 1, F.concat(F.lit("0"), p)).otherwise(p)

    norm = F.concat_ws(
        "-", F.element_at(parts, 1),
        pad(F.element_at(parts, 2)), pad(F.element_at(parts, 3)))
    return F.when(d.contains("/") & (F.size(parts) == 3), norm).otherwise(d)
