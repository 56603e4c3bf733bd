"""Column functions: pure ``Column -> Column`` helpers, no I/O, no actions.

Everything here is a built-in Spark expression so it stays inside whole-stage
codegen.  Semantics follow the reference's pandas/NumPy behaviour where the two
differ from Spark's defaults (right-closed bins, half-even rounding, Python
``title()``, NULL-preserving clips).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------- numeric

def clip(c: ColumnOrName, lo: float | None = None, hi: float | None = None) -> Column:
    """``clip(lo, hi)`` that keeps NULL (``greatest``/``least`` skip NULLs)."""
    x = col(c)
    out = x
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(x.isNull(), F.lit(None)).otherwise(out)


def guarded_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` when ``den > 0``, else NULL (never raises under ANSI)."""
    d = col(den)
    return F.try_divide(col(num).cast("double"), F.when(d > 0, d.cast("double")))


def positive_or_null(c: ColumnOrName) -> Column:
    x = col(c)
    return F.when(x > 0, x)


def round_half_even(c: ColumnOrName, digits: int = 0) -> Column:
    """NumPy rounding: half to even on the binary value ``x * 10^d``.

    ``bround`` alone rounds the shortest decimal string (2469.885 -> 2469.88)
    while NumPy/pandas give 2469.89 because the double is slightly above the
    tie; scaling first keeps exact ties (0.125, 2.5) half-even and the rest as
    NumPy does.
    """
    if digits == 0:
        return F.bround(col(c), 0)
    m = float(10 ** digits)
    return F.bround(col(c) * F.lit(m), 0) / F.lit(m)


def safe_int(c: ColumnOrName, default: int = 0) -> Column:
    """Text or number -> int, truncating toward zero; anything unparsable -> default."""
    as_double = F.trim(col(c).cast("string")).try_cast("double")
    return F.coalesce(as_double.try_cast("int"), F.lit(default))


def coerce_numeric(c: ColumnOrName) -> Column:
    """``pd.to_numeric(errors='coerce')``: bad text -> NULL."""
    return F.trim(col(c).cast("string")).try_cast("double")


def log1p(c: ColumnOrName) -> Column:
    return F.log1p(col(c))


def expm1(c: ColumnOrName) -> Column:
    return F.expm1(col(c))


def scale_anchors(v: ColumnOrName, best: ColumnOrName | float, worst: ColumnOrName | float,
                  missing: float = 0.5, top: float = 1.0) -> Column:
    """Linear score with two anchors clamped to [0, top]; NULL -> ``missing``.

    ``best`` may be below ``worst`` (lower is better); the formula handles both.
    """
    b = col(best) if not isinstance(best, (int, float)) else F.lit(float(best))
    w = col(worst) if not isinstance(worst, (int, float)) else F.lit(float(worst))
    x = col(v)
    raw = F.try_divide(x - w, b - w)
    scaled = F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0)) * F.lit(top)
    return F.when(x.isNull() | raw.isNull(), F.lit(missing)).otherwise(scaled)


# --------------------------------------------------------------------------- binning

def bin_right_closed(c: ColumnOrName, edges: Sequence[float | None],
                     labels: Sequence[str] | None = None) -> Column:
    """``pd.cut`` semantics: bins ``(e[i], e[i+1]]``; outside (or NULL) -> NULL.

    ``None`` as the last edge means +infinity.  Without labels the 1-based bin
    ordinal is returned.
    """
    x = col(c)
    out = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = x > F.lit(lo)
        if hi is not None:
            cond = cond & (x <= F.lit(hi))
        val = F.lit(labels[i]) if labels is not None else F.lit(i + 1)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out


def bin_thresholds(c: ColumnOrName, thresholds: Sequence[float], labels: Sequence[str]) -> Column:
    """Left-closed cascade: ``x >= t0 -> l0``, ``x >= t1 -> l1`` ..., else the last label.

    ``labels`` has one more entry than ``thresholds``.  NULL input -> NULL.
    """
    x = col(c)
    out = None
    for t, lab in zip(thresholds, labels):
        out = F.when(x >= F.lit(t), F.lit(lab)) if out is None else out.when(x >= F.lit(t), F.lit(lab))
    out = out.otherwise(F.lit(labels[-1]))
    return F.when(x.isNotNull(), out)


def equal_width_bin(c: ColumnOrName, lo: float, width: float, n: int) -> Column:
    """Right-closed equal-width bin number in ``1..n`` over ``(lo, lo + n*width]``."""
    x = col(c)
    b = F.ceil((x - F.lit(lo)) / F.lit(width))
    return F.when((x > F.lit(lo)) & (x <= F.lit(lo + n * width)), b.cast("bigint"))


# --------------------------------------------------------------------------- text

def trim_truncate(c: ColumnOrName, n: int) -> Column:
    """``str(x).strip()[:n]`` keeping NULL as NULL."""
    return F.substring(F.trim(col(c).cast("string")), 1, n)


def code_as_text(c: ColumnOrName) -> Column:
    """ZIP-like code to text without a trailing ``.0``."""
    return F.substring_index(col(c).cast("string"), ".", 1)


def title_case(c: ColumnOrName) -> Column:
    """Python ``str.title()``: capitalise after any non-letter, lower the rest."""
    parts = F.regexp_extract_all(col(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.when(col(c).isNotNull(),
                  F.array_join(F.transform(parts, lambda z: F.initcap(z)), ""))


def strip_suffix(c: ColumnOrName, suffixes: Sequence[str]) -> Column:
    pattern = r"\s+(" + "|".join(suffixes) + r")$"
    return F.regexp_replace(col(c), pattern, "")


def money_label(c: ColumnOrName) -> Column:
    """``$1.23M``."""
    return F.format_string("$%.2fM", col(c) / F.lit(1e6))


def split_key(c: ColumnOrName, sep: str = "_") -> tuple[Column, Column]:
    """Split a composite key on the first separator."""
    x = col(c)
    head = F.substring_index(x, sep, 1)
    tail = F.substring(x, F.length(head) + 2, 1 << 30)
    return head, F.when(F.instr(x, sep) > 0, tail)


def parse_number_lenient(c: ColumnOrName) -> Column:
    """Dialect (a): drop ``,``/``USD``/``$``; first run of digits and dots; else 0."""
    s = F.regexp_replace(col(c).cast("string"), r",|USD|\$", "")
    run = F.regexp_extract(s, r"([0-9.]+)", 1)
    return F.coalesce(F.when(run != "", run.try_cast("double")), F.lit(0.0))


def parse_number_units(c: ColumnOrName) -> Column:
    """Dialect (b): strip a leading ``USD``, a trailing ``per Nk...`` and ``yr(s)``, then
    ``%``/``$``/``,``; NULL when the rest is not a number.  ``(?U)`` makes ``\\s`` match
    the no-break space as Python does."""
    s = F.trim(col(c).cast("string"))
    s = F.regexp_replace(s, r"(?U)^USD\s*", "")
    s = F.regexp_replace(s, r"(?iU)\s*per\s+\d+k.*$", "")
    s = F.regexp_replace(s, r"(?iU)\s+yrs?$", "")
    s = F.regexp_replace(s, r"[%$,]", "")
    return F.trim(s).try_cast("double")


def parse_number_cut(c: ColumnOrName) -> Column:
    """Dialect (c): strip a leading ``USD`` and everything from ``per Nk``/``yr``/``%`` on."""
    s = F.trim(col(c).cast("string"))
    s = F.regexp_replace(s, r"(?U)^USD\s*", "")
    s = F.regexp_replace(s, r"(?iU)\s*(per\s+\d+k.*|yrs?|%).*", "")
    s = F.regexp_replace(s, r"[$,]", "")
    return F.trim(s).try_cast("double")


# --------------------------------------------------------------------------- dates

DAY_FIRST_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "d/M/yyyy", "d-M-yyyy", "d.M.yyyy")
ISO_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "M/d/yyyy")


def parse_date(c: ColumnOrName, day_first: bool = False) -> Column:
    """Text -> DATE trying several patterns; anything else -> NULL."""
    fmts = DAY_FIRST_FORMATS if day_first else ISO_FORMATS
    x = F.trim(col(c).cast("string"))
    return F.coalesce(*[F.try_to_timestamp(x, F.lit(f)) for f in fmts]).cast("date")


def month_start(year: ColumnOrName, month: ColumnOrName) -> Column:
    return F.make_date(col(year), col(month), F.lit(1))


def weekday_mon0(c: ColumnOrName) -> Column:
    """Day of week, Monday = 0 (pandas ``dayofweek``)."""
    return F.weekday(col(c))


# --------------------------------------------------------------------------- hash

def adler32(c: ColumnOrName) -> Column:
    """zlib Adler-32 of the UTF-8 bytes, as a Spark fold (no UDF)."""
    hx = F.hex(F.encode(col(c), "UTF-8"))
    n = F.octet_length(col(c))
    idx = F.sequence(F.lit(0), n - 1)
    byte_vals = F.transform(idx, lambda i: F.conv(F.substring(hx, i * 2 + 1, 2), 16, 10).cast("long"))
    init = F.struct(F.lit(1).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))

    def step(acc, v):
        a = (acc["a"] + v) % 65521
        return F.struct(a.alias("a"), ((acc["b"] + a) % 65521).alias("b"))

    folded = F.aggregate(F.when(n > 0, byte_vals).otherwise(F.array().cast("array<long>")), init, step)
    return (folded["b"] * F.lit(65536) + folded["a"]).cast("long")


def fingerprint16(*cols: ColumnOrName) -> Column:
    """First 16 hex digits of MD5 over the row's text form (row-level file hash)."""
    return F.substring(F.md5(F.concat_ws("\u0001", *[col(c).cast("string") for c in cols])), 1, 16)
