"""JSON in text: values that may be JSON or plain, and JSON found within other text. Results are variants."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions.text import strip

# JSON between the first and last brace or bracket, and within a code fence.
OBJECT, LIST = r"(?s)\{.*\}", r"(?s)\[.*\]"
FENCED = r"(?s)```(?:json)?\s*(\{.*?\})\s*```"


def strict_json(text: Column) -> Column:
    """The text as JSON, null where it is none. The parser stops after the first value; what follows it is found by
    parsing the text as the one field of an object and as an item of a list, which no text with a rest survives both."""
    around = lambda a, b: F.try_parse_json(F.concat(F.lit(a), text, F.lit(b))).isNotNull()
    return F.when(around('{"x":', "}") & around("[", "]"), F.try_parse_json(text))


def json_or_raw(text: Column) -> Column:
    """The text as JSON where it is JSON, else the text itself; null stays null."""
    return F.coalesce(strict_json(text), text.cast("variant"))


def loose_json(text: Column, strict_legacy: bool = False) -> Column:
    """The JSON that a text is or holds: all of it, else what is from its first { to its last }, else, if it has none of
    these, from its first [ to its last ]; null where that is no JSON. ``strict_legacy`` leaves the first step out, so
    a list of objects is seldom found."""
    between = lambda pattern: strict_json(F.nullif(F.regexp_extract(text, pattern, 0), F.lit("")))
    both = lambda a, b: F.contains(text, F.lit(a)) & F.contains(text, F.lit(b))
    found = F.when(both("{", "}"), between(OBJECT)).when(both("[", "]"), between(LIST))
    return found if strict_legacy else F.coalesce(strict_json(text), found)


def fenced_json(text: Column) -> Column:
    """The JSON of an answer that may be wrapped in a code fence; null where it is none."""
    bare = strip(text)
    inner = F.nullif(F.regexp_extract(bare, FENCED, 1), F.lit(""))
    return strict_json(F.when(F.startswith(bare, F.lit("```")), F.coalesce(inner, bare)).otherwise(bare))
