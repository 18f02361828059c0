"""Colour and typography helpers as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelens.functions.common import col

HEX6_RE = r"^#([A-Fa-f0-9]{6})$"
HEX3_RE = r"^#([A-Fa-f0-9]{3})$"
RGB_RE = r"rgba?\s*\(\s*(\d+)\s*,\s*(\d+)\s*,\s*(\d+)"


def is_color_property(key) -> Column:
    """Setting key names a colour: contains 'color', 'background' or '__globals__'.

    The reference's 22-name list plus its '_color' rule reduce to these
    substrings (every listed name contains one of them).
    """
    k = col(key)
    return F.contains(k, F.lit("color")) | F.contains(k, F.lit("background")) | F.contains(k, F.lit("__globals__"))


def is_typography_property(key) -> Column:
    """Setting key names typography: contains 'typography', 'font_family' or '__globals__'."""
    k = col(key)
    return (F.contains(k, F.lit("typography")) | F.contains(k, F.lit("font_family"))
            | F.contains(k, F.lit("__globals__")))


def is_valid_color(value) -> Column:
    """#RGB, #RRGGBB, or a value starting with rgb( / rgba(."""
    v = col(value)
    return v.rlike(r"^#([A-Fa-f0-9]{6}|[A-Fa-f0-9]{3})$") | v.rlike(r"^rgba?\s*\(")


def normalize_hex(value) -> Column:
    """Upper-case #RRGGBB; 3-digit hex doubled; rgb()/rgba() formatted %02X; else NULL.

    Channel values above 255 give more than two hex digits (kept, as the
    reference does; such values never parse as 6-digit hex later).
    """
    v = col(value)
    h3 = F.regexp_extract(v, HEX3_RE, 1)
    doubled = F.concat(F.lit("#"), F.upper(F.concat(
        F.repeat(F.substring(h3, 1, 1), 2), F.repeat(F.substring(h3, 2, 1), 2), F.repeat(F.substring(h3, 3, 1), 2))))
    ch = [F.regexp_extract(v, RGB_RE, i).cast("decimal(38,0)") for i in (1, 2, 3)]
    rgb = F.format_string("#%02X%02X%02X", *[c.cast("bigint") for c in ch])
    return (F.when(v.rlike(HEX6_RE), F.upper(v))
            .when(v.rlike(HEX3_RE), doubled)
            .when(v.rlike(RGB_RE) & ch[0].isNotNull() & ch[1].isNotNull() & ch[2].isNotNull(), rgb))


def hex_to_rgb(hex_value) -> Column:
    """struct(r, g, b) for exactly six characters after leading '#'s, else NULL."""
    h = F.ltrim(col(hex_value), F.lit("#"))
    ok = F.length(h) == 6

    def chan(i):
        # hexdec ignores non-hex characters
        digits = F.regexp_replace(F.substring(h, i, 2), "[^0-9A-Fa-f]", "")
        return F.coalesce(F.conv(F.when(digits != "", digits), 16, 10).cast("int"), F.lit(0))
    return F.when(ok, F.struct(chan(1).alias("r"), chan(3).alias("g"), chan(5).alias("b")))


def luminance(rgb) -> Column:
    r = col(rgb)
    return (F.lit(0.299) * r["r"] + F.lit(0.587) * r["g"] + F.lit(0.114) * r["b"]) / F.lit(255.0)


def color_distance_lt(rgb1, rgb2, threshold: float = 30.0) -> Column:
    """Euclidean RGB distance below the threshold; NULL inputs are not similar."""
    a, b = col(rgb1), col(rgb2)
    d = F.sqrt(F.pow(a["r"] - b["r"], 2) + F.pow(a["g"] - b["g"], 2) + F.pow(a["b"] - b["b"], 2))
    return F.coalesce(d < F.lit(threshold), F.lit(False))


def color_name(hex_value, contexts, rgb=None) -> Column:
    """Name suggested from the contexts (setting keys), else luminance, else hue.

    Pass a precomputed ``rgb`` struct column to avoid re-deriving it per use.
    """
    rgb = hex_to_rgb(hex_value) if rgb is None else col(rgb)
    ctx = F.array_join(col(contexts), " ")
    lum = luminance(rgb)
    r, g, b = rgb["r"], rgb["g"], rgb["b"]
    mx, mn = F.greatest(r, g, b), F.least(r, g, b)
    return (F.when(rgb.isNull(), F.lit("Color"))
            .when(F.contains(ctx, F.lit("button")), F.lit("Button Color"))
            .when(F.contains(ctx, F.lit("heading")) | F.contains(ctx, F.lit("title")), F.lit("Heading Color"))
            .when(F.contains(ctx, F.lit("background")), F.lit("Background"))
            .when(F.contains(ctx, F.lit("link")), F.lit("Link Color"))
            .when(lum > 0.95, F.lit("White/Light"))
            .when(lum < 0.05, F.lit("Black/Dark"))
            .when(lum > 0.8, F.lit("Light Background"))
            .when(lum < 0.2, F.lit("Dark Text"))
            .when(mx - mn < 20, F.lit("Neutral Gray"))
            .when((r >= g) & (r >= b), F.when(g > b, F.lit("Orange/Yellow")).otherwise(F.lit("Red/Pink")))
            .when((g >= r) & (g >= b), F.when(b > r, F.lit("Teal/Cyan")).otherwise(F.lit("Green")))
            .when((b >= r) & (b >= g), F.when(r > g, F.lit("Purple/Violet")).otherwise(F.lit("Blue")))
            .otherwise(F.lit("Accent Color")))


def php_intval(s) -> Column:
    """Leading integer of a string (PHP intval); 0 when none."""
    m = F.regexp_extract(col(s), r"^\s*([+-]?\d+)", 1)
    return F.coalesce(F.when(m != "", m).try_cast("bigint"), F.lit(0))


def font_weights(*weights) -> Column:
    """Distinct non-zero integer weights, sorted; [400] when none."""
    ws = F.array(*[php_intval(w) for w in weights])
    kept = F.array_distinct(F.filter(ws, lambda x: x != 0))
    return F.when(F.size(kept) == 0, F.array(F.lit(400).cast("bigint"))).otherwise(F.array_sort(kept))


def ucfirst(s) -> Column:
    c = col(s)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))
