"""Column builders that read answers: yes or no, numbers, units, options, question classes, and their scores."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

YES = "yes|yeah|yep|correct|true|right|indeed|affirmative"
NO = "no|nope|false|incorrect|wrong|negative"
NUMBER_WORDS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty".split()
# The units of length and how many centimetres each has.
TO_CM = {"m": 100.0, "meter": 100.0, "meters": 100.0, "metre": 100.0, "metres": 100.0,
         "cm": 1.0, "centimeter": 1.0, "centimeters": 1.0, "centimetre": 1.0, "centimetres": 1.0,
         "mm": 0.1, "millimeter": 0.1, "millimeters": 0.1,
         "ft": 30.48, "foot": 30.48, "feet": 30.48,
         "in": 2.54, "inch": 2.54, "inches": 2.54}
UNITS = "|".join(sorted(TO_CM, key=lambda u: (-len(u), u)))
#: Right-hand sides of the ten relative-error thresholds 0.5, 0.55, ... 0.95, as doubles.
MRA_LIMITS = (0.5, 0.44999999999999996, 0.4, 0.35, 0.30000000000000004, 0.25, 0.19999999999999996, 0.15000000000000002, 0.10000000000000009, 0.050000000000000044)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def hit(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null without one."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def word(words: str, anchored: bool = False) -> str:
    return ("^" if anchored else r"(^|[^\p{L}\p{N}_])") + f"({words})" + r"([^\p{L}\p{N}_]|$)"


def yes_no(c: Column) -> Column:
    """True, False or null: a conclusion tag, then the first clause, then the whole text if it has one side only."""
    t = F.lower(strip(c))
    tag = hit(t, r"<conclusion>\s*(yes|no)\s*</conclusion>")
    head = strip(F.substring_index(F.substring_index(t, ",", 1), ".", 1))
    yes, no = t.rlike(word(YES)), t.rlike(word(NO))
    return (
        F.when(tag.isNotNull(), tag == "yes")
        .when(head.rlike(word(YES, True)), True)
        .when(head.rlike(word(NO, True)), False)
        .when(head == "actually", False)
        .when(yes & ~no, True)
        .when(no & ~yes, False)
    )


def number(c: Column) -> Column:
    """The number of a conclusion tag, else the first in digits, else the least that is spelled out (zero to twenty)."""
    t = F.lower(strip(c))
    tag = hit(t, r"<conclusion>\s*([0-9.]+)\s*</conclusion>").try_cast("double")
    digits = F.replace(hit(t, r"([0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?)"), F.lit(","), F.lit("")).try_cast("double")
    found = F.regexp_extract_all(t, F.lit(rf"(?<!{_LETTER})({'|'.join(NUMBER_WORDS)})(?!{_LETTER})"), F.lit(1))
    known = F.array(*[F.lit(w) for w in NUMBER_WORDS])
    spelled = F.array_min(F.transform(found, lambda w: F.array_position(known, w) - 1)).cast("double")
    return F.coalesce(tag, digits, spelled)


#: A letter, digit or underscore of any script: what a word goes on with.
_LETTER = r"[\p{L}\p{N}_]"
_MEASURE = rf"([0-9]+(?:\.[0-9]+)?)\s*({UNITS})(?!{_LETTER})"


def measure_value(c: Column) -> Column:
    return hit(F.lower(c), _MEASURE, 1).try_cast("double")


def measure_unit(c: Column) -> Column:
    return hit(F.lower(c), _MEASURE, 2)


def to_cm(value: Column, unit: Column) -> Column:
    factors = F.create_map(*[F.lit(x) for kv in TO_CM.items() for x in kv])
    return value * F.try_element_at(factors, unit)


# Fixed patterns, tried in this order on the stripped text.
OPTION_FORMS = (
    rf"[Aa]nswer\s*:\s*([A-Fa-f])(?!{_LETTER})",
    rf"(?i)answer\s+is\s+([A-F])(?!{_LETTER})",
    r"<conclusion>\s*\(?([A-Fa-f])\)?\s*</conclusion>",
    r"[\(\[]([A-Fa-f])[\)\]]",
    rf"(?<!{_LETTER})([A-Fa-f])[.,;:]\s",
    r"^([A-Fa-f])\.?$",
)


def option(c: Column) -> Column:
    """A to F, by a cascade from the most to the least explicit form; else null."""
    t = strip(c)
    return F.coalesce(*[F.upper(hit(t, f)) for f in OPTION_FORMS])


# Fixed patterns by which a question's class is told.
DISTANCE_ASKED = "distance between|how far|how close|how distant|measure the distance|distance of the|distance from|distance measurement"
MEASUREMENT_ASKED = "width of|height of|how wide|how tall|measure the width|measure the height|horizontal dimensions|vertical dimensions|radius of"
CHOICE_ASKED = (
    "which is more to the|which one appears|who is positioned more|which is above|which is below|which one is positioned|"
    "who is taller|who is shorter|who is higher|who is lower"
)
PREDICATE_ASKED = "^is the |^does the |^can you confirm"


def question_class(c: Column) -> Column:
    t = F.lower(strip(c))
    far = t.rlike(DISTANCE_ASKED)
    return (
        F.when(far & F.contains(t, F.lit("vertic")), "vertical_distance")
        .when(far & F.contains(t, F.lit("horizont")), "horizontal_distance")
        .when(far, "distance")
        .when(t.rlike(MEASUREMENT_ASKED), "measurement")
        .when(t.rlike(CHOICE_ASKED), "comparison_choice")
        .when(t.rlike(PREDICATE_ASKED), "comparison_yn")
        .otherwise("unknown")
    )


def score_yes_no(pred: Column, truth: Column) -> Column:
    return (yes_no(pred) == yes_no(truth)).cast("double")


READ = ("value", "unit", "number")


def with_readings(df: DataFrame, *texts: str) -> DataFrame:
    """Columns {text}_value, {text}_unit and {text}_number of each text column: every pattern runs once for a text, however
    many scores read it."""
    read = {"value": measure_value, "unit": measure_unit, "number": number}
    return df.withColumns({f"{t}_{k}": read[k](F.col(t)) for t in texts for k in READ})


def _lengths(pred: str, truth: str) -> tuple[Column, Column]:
    """Both in cm if both have a unit, else both bare numbers."""
    p, g = ({k: F.col(f"{t}_{k}") for k in READ} for t in (pred, truth))
    both = p["value"].isNotNull() & g["value"].isNotNull()
    return tuple(F.when(both, to_cm(x["value"], x["unit"])).otherwise(x["number"]) for x in (p, g))


def with_lengths(df: DataFrame, pred: str = "pred", truth: str = "truth") -> DataFrame:
    """``with_readings`` and the two lengths that distance scores compare: ``p`` and ``g``, doubles."""
    p, g = _lengths(pred, truth)
    return with_readings(df, pred, truth).withColumns({"p": p, "g": g})


def score_distance(tolerance: float = 2.0, p: str = "p", g: str = "g") -> Column:
    """1 if the larger length is less than ``tolerance`` times the smaller, null if one is missing. Of columns of ``with_lengths``."""
    p, g = F.col(p), F.col(g)
    ratio = F.greatest(F.try_divide(p, g), F.try_divide(g, p))
    return F.when((p == 0) & (g == 0), 1.0).when((p == 0) | (g == 0), 0.0).when(p.isNotNull() & g.isNotNull(), (ratio < tolerance).cast("double"))


def score_mra(p: str = "p", g: str = "g") -> Column:
    """Mean over ten thresholds of: relative error within it. Of columns of ``with_lengths``."""
    p, g = F.col(p), F.col(g)
    err = F.abs(p - g) / F.nullif(F.abs(g), F.lit(0.0))
    hits = F.size(F.filter(F.array(*[F.lit(x) for x in MRA_LIMITS]), lambda x: err <= x)) / F.lit(10.0)
    return F.when(p.isNull() | g.isNull(), None).when(g == 0, (p == 0).cast("double")).otherwise(hits)


def score_choice(pred: Column, truth: Column, question: Column) -> Column:
    """Whether the answer has the name that the truth has, of the two that the question offers. If the truth has both or
    none, or the question offers none, the whole texts are compared."""
    q, p, g = F.lower(question), strip(F.lower(pred)), strip(F.lower(truth))
    names = r"the\s+(.+?)\s+or\s+the\s+(.+?)[\?\.]"
    a, b = strip(hit(q, names, 1)), strip(hit(q, names, 2))
    has_a, has_b = F.contains(g, a), F.contains(g, b)
    named = F.when(has_a & ~has_b, a).when(has_b & ~has_a, b)
    return F.when(named.isNotNull(), F.contains(p, named)).otherwise(p == g).cast("double")


def judge_score(c: Column) -> Column:
    return hit(c, r"\[([0-9]+(?:\.[0-9]+)?)\]").try_cast("double")


def first_distance(c: Column) -> Column:
    """The first number after ' Answer: '."""
    return hit(F.get(F.split(c, " Answer: ", 2), F.lit(1)), r"([0-9]+\.[0-9]+|[0-9]+)").try_cast("double")


def percent_of(value: Column, extent: Column) -> Column:
    """value / extent in percent, clamped to [0, 100], two decimals. An extent that is not positive is an error."""
    return F.when(extent > 0, F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0), value / extent * 100)), 2)).otherwise(F.raise_error(F.lit("extent must be positive")).cast("double"))


def point_tag(x: Column, y: Column, width: Column, height: Column, alt: Column | None = None) -> Column:
    """A pointing tag in percent of the image, two decimals at most; a missing or empty alt text is "point"."""
    pct = lambda v, n: percent_of(v, n).cast("string")
    alt = F.lit("point") if alt is None else F.coalesce(F.nullif(alt, F.lit("")), F.lit("point"))
    return F.concat(F.lit('<point x="'), pct(x, width), F.lit('" y="'), pct(y, height), F.lit('" alt="'), alt, F.lit('">'))


def joint_tag(x: Column, y: Column, width: Column, height: Column, alt: Column) -> Column:
    """The same with one decimal, closed in itself, not clamped."""
    pct = lambda v, n: F.round(v / n * 100, 1).cast("string")
    return F.concat(F.lit('<point x="'), pct(x, width), F.lit('" y="'), pct(y, height), F.lit('" alt="'), alt, F.lit('"/>'))


def captions(c: Column) -> Column:
    """The alt texts of all point tags, stripped and lower-cased."""
    return F.transform(F.regexp_extract_all(c, F.lit(r'<point [^>]*?alt="([^"]*)"\s*/?>'), F.lit(1)), lambda x: F.lower(F.trim(x)))


def sentences(c: Column) -> Column:
    """The parts of a caption between full stops, stripped, without empty ones."""
    return F.filter(F.transform(F.split(c, r"\."), strip), lambda x: x != "")


def short_text(c: Column, most: int = 48) -> Column:
    """A caption cut to ``most`` characters, with an ellipsis where something went."""
    return F.when(F.char_length(c) > most, F.concat(F.rtrim(F.left(c, F.lit(most))), F.lit("\u2026"))).otherwise(c)


def fill(template: Column, **by: Column) -> Column:
    """Placeholders [A], [B], [X], ... replaced, one after the other."""
    for name, value in by.items():
        template = F.replace(template, F.lit(f"[{name}]"), value)
    return template


def described(c: Column) -> Column:
    """The descriptions of a JSON object of objects that was cut off: the last entry, begun but not ended, is left out."""
    whole = F.concat(F.regexp_replace(c, r'(?s),\s*"object(?!.*,\s*"object).*$', ""), F.lit("}"))
    kind = "map<string,struct<description:string>>"
    read = F.coalesce(F.from_json(c, kind, {"mode": "PERMISSIVE"}), F.from_json(whole, kind))
    return F.transform(F.map_values(read), lambda x: F.replace(x["description"], F.lit("."), F.lit("")))


def parse_points(c: Column, width: Column, height: Column) -> Column:
    """array<struct<x,y,alt>> in pixels of all point tags, with or without a slash; out-of-range ones are dropped."""
    tag = r'<point x="([0-9.]+)" y="([0-9.]+)" alt="([^"]*)"\s*/?>'
    parts = F.arrays_zip(*[F.regexp_extract_all(c, F.lit(tag), F.lit(i)).alias(n) for i, n in ((1, "x"), (2, "y"), (3, "alt"))])
    read = F.transform(parts, lambda p: F.struct(p["x"].try_cast("double").alias("x"), p["y"].try_cast("double").alias("y"), F.lower(F.trim(p["alt"])).alias("alt")))
    return F.transform(F.filter(read, lambda p: F.greatest(p["x"], p["y"]) <= 100), lambda p: F.struct((p["x"] / 100 * width).alias("x"), (p["y"] / 100 * height).alias("y"), p["alt"].alias("alt")))


def json_of(c: Column) -> Column:
    """JSON in a model's reply: the text without thinking blocks and the fence around it if that is JSON, else the object that
    begins at its first brace; null if there is none or it does not end."""
    bare = strip(F.regexp_replace(c, r"(?s)<think>.*?</think>", ""))
    bare = F.regexp_replace(bare, r"(?s)^```[^\n]*\n(.*)```.*$", "$1")

    @F.pandas_udf("string")
    def first_object(texts: pd.Series) -> pd.Series:
        decoder = json.JSONDecoder()

        def read(t: str | None) -> str | None:
            at = t.find("{") if t else -1
            try:
                return t[at : decoder.raw_decode(t, at)[1]] if at >= 0 else None
            except ValueError:
                return None

        return texts.map(read)

    whole = F.when(F.try_parse_json(bare).isNotNull(), strip(bare))
    return F.coalesce(whole, first_object(F.when(whole.isNull(), bare)))


COMPASS = ("north", "northeast", "east", "southeast", "south", "southwest", "west", "northwest")


def compass(azimuth: Column) -> Column:
    """The nearest of eight directions, halves to the even one."""
    names = F.array(*[F.lit(x) for x in COMPASS])
    return F.element_at(names, (F.pmod(F.bround(azimuth / 45), F.lit(8)) + 1).cast("int"))


def _banded(value: Column, names: tuple[str, str, str, str, str]) -> Column:
    """One of five words: up to -60, below -15, up to 15, below 60, and beyond."""
    return F.when(value <= -60, names[0]).when(value < -15, names[1]).when(value <= 15, names[2]).when(value < 60, names[3]).otherwise(names[4])


def orientation_text(azimuth: Column, polar: Column, rotation: Column, confidence: Column) -> Column:
    """Heading, tilt, roll and confidence in words."""
    tilt = _banded(polar, ("steeply downward", "slightly downward", "level", "slightly upward", "steeply upward"))
    roll = _banded(wrap_degrees(rotation), ("rolled hard left", "slight roll left", "upright", "slight roll right", "rolled hard right"))
    sure = F.when(confidence >= 0.75, "high").when(confidence >= 0.4, "moderate").otherwise("low")
    return F.concat(F.lit("facing "), compass(azimuth), F.lit(", "), tilt, F.lit(", "), roll, F.lit(", "), sure, F.lit(" confidence"))


def wrap_degrees(d: Column) -> Column:
    return F.pmod(d + 180, F.lit(360)) - 180
