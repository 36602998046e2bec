"""Column functions over file names and object keys (all JVM-side, codegen'd).

Every function takes and returns a ``Column``; use them in ``select``/``where``.
Digits are Unicode decimal digits (``\\p{Nd}``), as in Python's ``\\d``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumisort._compat import col_of


def label_from_name(c) -> Column:
    """Text before the first digit, trailing ``_`` removed.

    ``yorkshire_terrier_98.jpg`` -> ``yorkshire_terrier``; no digit -> whole name
    (extension included); leading digit -> ``''``.
    """
    c = col_of(c)
    return F.regexp_replace(F.regexp_extract(c, r"^[^\p{Nd}]*", 0), r"_+$", "")


def label_first_token(c) -> Column:
    """Text before the first ``_`` (``Egyptian_Mau_1`` -> ``Egyptian``)."""
    return F.split_part(col_of(c), F.lit("_"), F.lit(1))


def strip_root(c) -> Column:
    """Drop the first path component; ``''`` when there is no ``/``."""
    c = col_of(c)
    pos = F.instr(c, "/")
    return F.when(pos > 0, c.substr(pos + 1, F.length(c))).otherwise(F.lit(""))


def basename(c) -> Column:
    """Last ``/`` component (``''`` for a trailing ``/``)."""
    return F.element_at(F.split(col_of(c), "/"), -1)


def stem(c) -> Column:
    """Drop the last ``.``-part and join the rest without dots.

    ``a.b.jpg`` -> ``ab``; a name without a dot -> ``''``.
    """
    parts = F.split(col_of(c), r"\.")
    return F.array_join(F.slice(parts, 1, F.size(parts) - 1), "")


def jpg_stem(c) -> Column:
    """Object-key form: for names ending in ``jpg``, the text up to the first
    ``<any char>jpg`` plus ``.json``; other names pass through unchanged.

    ``x.jpg.jpg`` -> ``x.json``; ``foojpg`` -> ``fo.json``.
    """
    c = col_of(c)
    return F.when(c.endswith("jpg"), F.concat(F.regexp_extract(c, r"^(.*?).jpg", 1), F.lit(".json"))).otherwise(c)


def has_suffix(c, suffix: str = "json") -> Column:
    """Suffix filter (``*json``)."""
    return col_of(c).endswith(suffix)


def is_placeholder(c) -> Column:
    """Directory placeholder keys: empty last component."""
    return F.coalesce(basename(c) == F.lit(""), F.lit(True))


def ratio_label(c) -> Column:
    """``'<c>/<round(1-c, 2)>'``, e.g. 0.3 -> ``0.3/0.7``."""
    c = col_of(c).cast("double")
    return F.concat(c.cast("string"), F.lit("/"), F.round(F.lit(1.0) - c, 2).cast("string"))


def ratio_text(cutoff: float) -> str:
    """``ratio_label`` of a parameter."""
    return f"{float(cutoff)}/{round(1 - float(cutoff), 2)}"


def format_percent(c) -> Column:
    """Report form ``'%.2f'`` of an accuracy already in percent.

    Java's formatter rounds half-up on the decimal text, so exact binary ties
    (rare for accuracies) can differ from Python's ``'%.2f'``; results keep the double.
    """
    return F.format_string("%.2f", col_of(c).cast("double"))


def prediction_to_class(c, negative: str, positive: str) -> Column:
    """0 -> ``negative`` class name, anything else -> ``positive``; NULL stays NULL."""
    c = col_of(c)
    return F.when(c.isNull(), F.lit(None).cast("string")).when(c == 0, F.lit(negative)).otherwise(F.lit(positive))
