"""Text functions as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.modes import CORRECTIONS, MAX_SPECIAL, MIN_CONFIDENCE, MIN_LENGTH, MIN_LETTERS

#: All Unicode white space (Java's own class lacks most of it).
BLANK = r"[\s\x1c-\x1f\x85\p{Z}]+"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def stripped(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), f"^{BLANK}|{BLANK}$", "")


def corrected(text: Column | str, table: Iterable[tuple[str, str]] = CORRECTIONS) -> Column:
    """Each misread string replaced, in the table's order: a result can be input to a later entry."""
    out = _col(text)
    for wrong, right in table:
        out = F.replace(out, F.lit(wrong), F.lit(right))
    return out


def camel_split(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), "([a-z])([A-Z])", "$1 $2")


def cleaned(text: Column | str, table: Iterable[tuple[str, str]] = CORRECTIONS) -> Column:
    return F.trim(F.regexp_replace(camel_split(corrected(text, table)), BLANK, " "))


def token_count(text: Column | str) -> Column:
    return F.size(F.array_remove(F.split(_col(text), BLANK), ""))


def letter_share(text: Column | str) -> Column:
    text = _col(text)
    return F.when(F.length(text) > 0, F.length(F.regexp_replace(text, r"\P{L}+", "")) / F.length(text)).otherwise(F.lit(0.0))


def special_share(text: Column | str) -> Column:
    text = _col(text)
    return F.when(F.length(text) > 0, F.length(F.regexp_replace(text, r"[\p{L}\p{N}\s\x1c-\x1f\x85\p{Z}]+", "")) / F.length(text)).otherwise(F.lit(0.0))


def is_quality(text: Column | str, confidence: Column | str) -> Column:
    """Enough confidence (an unknown one, NaN, passes), letters and length. Special characters never decide beyond that."""
    faults = quality_faults(text, confidence)
    return ~(faults["confidence"] | faults["length"] | faults["letters"] | faults["special"])


def quality_faults(text: Column | str, confidence: Column | str) -> dict[str, Column]:
    """Each rule of :func:`is_quality` by name, as whether a line breaks it."""
    text, confidence = _col(text), _col(confidence)
    return {
        "confidence": (confidence < MIN_CONFIDENCE) & ~F.isnan(confidence), "length": F.length(stripped(text)) < MIN_LENGTH,
        "letters": letter_share(text) < MIN_LETTERS, "special": special_share(text) > MAX_SPECIAL,
    }


def line_class(text: Column | str, height: Column | str, y: Column | str) -> Column:
    """TITLE, HEADER, LIST_ITEM, SECTION, CAPTION or PARAGRAPH; the first rule that holds."""
    text, height, y = _col(text), _col(height), _col(y)
    low = F.lower(stripped(text))
    listed = low.rlike(r"^(?:[•\-◦▪]|[1-5]\.)")
    section = low.contains("chapter") | low.contains("section") | low.contains("figure")
    return (
        F.when((height > 25) & (F.length(text) < 100), "TITLE")
        .when((height > 20) & (y < 200), "HEADER")
        .when(listed, "LIST_ITEM")
        .when(section, "SECTION")
        .when(F.length(text) < 50, "CAPTION")
        .otherwise("PARAGRAPH")
    )


def line_report(number: Column | str, kind: Column | str, text: Column | str, height: Column | str, y: Column | str, confidence: Column | str) -> Column:
    """A line of fixed widths: number, class, the text's first 50 characters, height, top and confidence."""
    cut = F.rpad(F.substring(_col(text), 1, 50), 50, " ")
    return F.format_string("%2d. [%s] %s (h:%3d, y:%3d, conf:%.2f)", _col(number), F.rpad(_col(kind), 10, " "), cut, _col(height), _col(y), _col(confidence))


def label_colour(label: Column | str) -> Column:
    """The display colour of a block label, red, green, blue; grey for others."""
    # Fixed values.
    colours = {"title": (255, 0, 0), "text": (0, 255, 0), "header": (0, 0, 255), "figure": (255, 255, 0), "table": (255, 0, 255), "footer": (128, 128, 128), "reference": (0, 128, 255)}
    low, out = F.lower(_col(label)), F.array(*[F.lit(128)] * 3)
    for name, rgb in colours.items():
        out = F.when(low == name, F.array(*map(F.lit, rgb))).otherwise(out)
    return out


# Word-break classes. Fixed values.
_EXTEND = r"[\p{M}\p{Cf}]*+"
_OTHER = r"(?![\x00-\x7F])"  # ASCII is told apart first: the classes of scripts are slow
_LETTERS = rf"(?:[a-zA-Z]++{_EXTEND}|{_OTHER}[\p{{L}}\p{{Nl}}&&[^\p{{IsHan}}\p{{IsHiragana}}\p{{IsKatakana}}\u30fc\uff70]]{_EXTEND})++"
_DIGITS = rf"(?:[0-9]++{_EXTEND}|{_OTHER}\p{{Nd}}{_EXTEND})++"
_BOTH = r".'\u2018\u2019\u2024\ufe52\uff07\uff0e"
_IN_WORDS = rf"[{_BOTH}:\u00b7\u0387\u2027\ufe55\uff1a]{_EXTEND}"
_IN_NUMBERS = rf"[{_BOTH},;\u060c\u066c\ufe50\ufe54\uff0c\uff1b]{_EXTEND}"
_PLAIN = r"""[a-zA-Z]++(?=[\x20\n,;!?()"-]|\.[\x20\n])"""  # most words end so: the same match as by the rest, without trying it
_WORD = rf"{_PLAIN}|(?:(?<!_)_++)?+(?:(?:{_LETTERS}(?:{_IN_WORDS}{_LETTERS})*+|{_DIGITS}(?:{_IN_NUMBERS}{_DIGITS})*+)_*+)++|{_OTHER}(?:[\p{{IsHan}}\p{{IsHiragana}}]{_EXTEND}|(?:[\p{{IsKatakana}}\u30fc\uff70]{_EXTEND})++)"
_PIECE = rf"{_WORD}|[^\p{{L}}\p{{Nl}}\p{{Nd}}_]++|_++|(?s:.)"


def terms(text: Column | str) -> Column:
    """Lower-case words in order, by the Unicode rules of word breaks.

    Letters go on over a point, colon or apostrophe between letters, digits over a point or comma between digits, both over ``_``; every Han or Hiragana
    character is a word, a run of Katakana is one. Scripts that need a dictionary (Thai, Khmer) give whole runs; emoji are no words. Null gives null.
    """
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(_WORD), F.lit(0))


def marked(text: Column, wanted: list[str]) -> Column:
    """The text with ``wanted`` terms in <em> marks."""
    is_wanted = lambda x: F.lower(x).isin(*wanted)
    pieces = F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0))
    return F.array_join(F.transform(pieces, lambda x: F.when(is_wanted(x), F.concat(F.lit("<em>"), x, F.lit("</em>"))).otherwise(x)), "") if wanted else text


def passages(text: Column, size: int) -> Column:
    """Sentences (they end with a line, or with a stop before white space), cut where needed into stretches of at most ``size`` characters:
    at white space, or within a word that is longer than that."""
    sentences = F.split(text, r"\n+|(?<=[.!?\u2026\u3002\uff01\uff1f])\s+")
    cut = rf"\S(?:.{{0,{size - 2}}}\S)?(?!\S)|\S{{1,{size}}}"
    return F.flatten(F.transform(sentences, lambda s: F.regexp_extract_all(s, F.lit(cut), F.lit(0))))


def best_passages(text: Column, wanted: list[str], size: int, number: int) -> Column:
    """Up to ``number`` passages that hold a wanted term, in the text's order, with their terms marked: those of most different terms, then of most terms, then the earliest."""

    def found(passage: Column, place: Column) -> Column:
        return F.struct(F.filter(terms(passage), lambda t: t.isin(*wanted)).alias("found"), place.alias("place"), passage.alias("passage"))

    def rated(r: Column) -> Column:
        return F.struct((-F.size(F.array_distinct(r["found"]))).alias("kinds"), (-F.size(r["found"])).alias("terms"), r["place"].alias("place"), r["passage"].alias("passage"))

    if not wanted:
        return F.array().cast("array<string>")
    rows = F.filter(F.transform(F.transform(passages(text, size), found), rated), lambda r: r["terms"] < 0)  # words are taken once
    best = F.slice(F.array_sort(rows), 1, number)
    in_order = F.array_sort(F.transform(best, lambda r: F.struct(r["place"].alias("place"), r["passage"].alias("passage"))))
    return F.transform(in_order, lambda r: marked(r["passage"], wanted))


def image_scale(width: Column | str, height: Column | str) -> Column:
    """Width and height after the size rule: up to 1200 at the shorter side, or else down to 2400 at the longer one."""
    w, h = _col(width).cast("double"), _col(height).cast("double")
    up, down = F.greatest(1200 / h, 1200 / w), F.least(2400 / h, 2400 / w)
    scale = F.when((h < 1200) | (w < 1200), up).when((h > 2400) | (w > 2400), down).otherwise(F.lit(1.0))
    return F.struct((w * scale).cast("int").alias("width"), (h * scale).cast("int").alias("height"))


def ascii_json(json: Column | str) -> Column:
    """JSON text with a space after each comma and colon between values, and other scripts as \\uXXXX (surrogate pairs for what needs them)."""
    # \G: from comma to comma, so that no match begins within a string
    spaced = F.regexp_replace(_col(json), r'\G((?:"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^",:]++)*+)([,:])', "$1$2 ")
    runs = F.regexp_extract_all(spaced, F.lit(r"[\x00-\x7E]+|[^\x00-\x7E]+"), F.lit(0))
    escaped = F.transform(runs, lambda x: F.when(x.rlike(r"^[\x00-\x7E]"), x).otherwise(F.regexp_replace(F.lower(F.hex(F.encode(x, "UTF-16BE"))), "(.{4})", r"\\u$1")))
    return F.when(spaced.rlike(r"[^\x00-\x7E]"), F.array_join(escaped, "")).otherwise(spaced)
