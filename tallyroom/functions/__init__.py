"""Column helpers. All of them stay inside Spark's built-in expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyroom.constants import DAY_INDEX_EPOCH, FAMILY_PREFIX_RX, FAMILY_SIZE_RX


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- numbers ---------------------------------------------------------------------

def safe_divide(a, b) -> Column:
    """Ratio as a double, NULL for a zero or NULL divisor."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def share_pct(hit: Column, digits: int = 1) -> Column:
    """Percentage of rows for which ``hit`` holds; NULL over no rows."""
    return F.round(safe_divide(F.count_if(hit) * F.lit(100.0), F.count("*")), digits)


def sum_if(cond: Column, value, otherwise=None) -> Column:
    """Conditional sum. NULL when nothing matched, unless ``otherwise`` is given."""
    branch = F.when(cond, col(value))
    return F.sum(branch if otherwise is None else branch.otherwise(F.lit(otherwise)))


def num_text(c, digits: int) -> Column:
    """Rounded number as text without trailing zeros: 12.50 -> 12.5, 3.00 -> 3."""
    text = F.round(col(c).cast("double"), digits).cast(f"decimal(30,{digits})").cast("string")
    if digits == 0:
        return text
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))


def score_text(c) -> Column:
    """A score as text: 5 for 5.0, 2.5 for 2.5."""
    return F.regexp_replace(col(c).cast("double").cast("string"), r"\.0$", "")


def whole_text(c) -> Column:
    return F.round(col(c).cast("double")).cast("bigint").cast("string")


def price_per_kg(price, uom, density) -> Column:
    """Price normalised to one kilogram; litres go through the density (1 if unknown)."""
    p = col(price).cast("double")
    return F.when(col(uom) == "kg", p).when(
        col(uom) == "L", safe_divide(p, F.coalesce(col(density).cast("double"), F.lit(1.0))))


def gross_from_net(net, loss_pct) -> Column:
    return safe_divide(col(net).cast("double"), F.lit(1.0) - col(loss_pct).cast("double") / 100)


# ---- text ----------------------------------------------------------------------------

def match_key(c) -> Column:
    """Key for comparing free-text names: case and outer blanks do not count."""
    return F.upper(F.trim(col(c)))


def audience_key(c) -> Column:
    """Audience name with case, punctuation and spacing removed."""
    return F.trim(F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", " "))


def product_family(c) -> Column:
    """Family of a product: its display name without line prefix and pack size."""
    return F.trim(F.regexp_replace(F.regexp_replace(col(c), FAMILY_PREFIX_RX, ""), FAMILY_SIZE_RX, ""))


def extract_or_null(c, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


def version_of(version, identifier) -> Column:
    """Stored version, else the ``-v<n>`` suffix of the identifier."""
    return F.coalesce(col(version), extract_or_null(identifier, r"-v(\d+)$").try_cast("bigint"))


def is_present(c) -> Column:
    """Presence of a value whose type is uncertain: blank and 'false' are absent."""
    return ~F.trim(col(c).cast("string")).isin("", "false")


def contains_any(c, terms: list[str]) -> Column:
    """Case-sensitive substring test against a list of terms (NULL text: false)."""
    hit = F.lit(False)
    for term in terms:
        hit = hit | col(c).contains(term)
    return F.coalesce(hit, F.lit(False))


def matches_any(c, pattern: str) -> Column:
    return F.lower(F.coalesce(col(c), F.lit(""))).rlike(pattern)


def list_size(c, sep: str = ";") -> Column:
    """Number of items in a delimited list; an empty text holds none."""
    text = col(c)
    return F.when(text == "", F.lit(0)).otherwise(
        F.length(text) - F.length(F.replace(text, F.lit(sep), F.lit(""))) + 1)


def pack(sep: str, *parts, default: str = "") -> Column:
    """Join fields positionally. A NULL field becomes ``default``, so it never
    blanks out the whole text."""
    out = []
    for i, part in enumerate(parts):
        if i:
            out.append(F.lit(sep))
        out.append(F.coalesce(col(part).cast("string"), F.lit(default)))
    return F.concat(*out)


def unpack(c, sep: str, position: int) -> Column:
    """Field ``position`` (from 0) of a packed text."""
    return F.split_part(col(c), F.lit(sep), F.lit(position + 1))


def flags_list(*pairs: tuple[Column, str], empty: str = "none") -> Column:
    """Comma list of the labels whose condition holds."""
    return F.coalesce(
        F.nullif(F.concat_ws(",", *[F.when(cond, F.lit(label)) for cond, label in pairs]), F.lit("")),
        F.lit(empty))


def generated_key(key, prefix: str, *basis) -> Column:
    """Given key, or a key computed from the row when it is blank. The same row
    always gets the same key, so a retried task writes the same rows; the key is
    the prefix and the whole digest of 64 digits, so different rows do not share one."""
    digest = F.sha2(F.concat_ws("\u0001", *[F.coalesce(col(b).cast("string"), F.lit("")) for b in basis]), 256)
    return F.coalesce(F.nullif(F.trim(col(key)), F.lit("")),
                      F.concat(F.lit(prefix), F.upper(digest)))


# ---- dates -----------------------------------------------------------------------------

def as_date(c) -> Column:
    return col(c).cast("date")


def days_until(c, as_of: date) -> Column:
    """Whole days from ``as_of`` to a date; negative in the past."""
    return F.datediff(as_date(c), F.lit(as_of)).cast("bigint")


def days_since(c, as_of: date) -> Column:
    return F.datediff(F.lit(as_of), as_date(c)).cast("bigint")


def day_index(c, epoch: date = DAY_INDEX_EPOCH) -> Column:
    return F.datediff(as_date(c), F.lit(epoch)).cast("bigint")


def month_of(c) -> Column:
    return F.trunc(as_date(c), "MM")


def in_trailing_days(c, as_of: date, days: int) -> Column:
    return as_date(c) >= F.date_sub(F.lit(as_of), days)


def in_force(start, end, as_of: date) -> Column:
    """Half-open validity: start <= as_of < end, an open end never closes."""
    return (col(start) <= F.lit(as_of)) & (col(end).isNull() | (F.lit(as_of) < col(end)))


# ---- ladders -----------------------------------------------------------------------------

def ladder(*arms: tuple[Column, object], otherwise=None) -> Column:
    """First matching arm wins; a NULL condition falls through."""
    out = None
    for cond, value in arms:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    if otherwise is not None:
        out = out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
    return out


def mapped(c, table: dict, otherwise=None) -> Column:
    return ladder(*[(col(c) == k, v) for k, v in table.items()], otherwise=otherwise)


def target_fit(cost, target) -> Column:
    """INSIDE up to half a paisa over the target, MARGINAL up to 5 % over."""
    return ladder((col(target).isNull(), "UNKNOWN"),
                  (col(cost) <= col(target) + 0.005, "INSIDE"),
                  (col(cost) <= col(target) * 1.05, "MARGINAL"), otherwise="OVER")
