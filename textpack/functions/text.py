"""Column functions on text. All are built-in expressions, so they stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textpack.constants import (
    ASSISTANT_TOKEN,
    COMMON_WORDS,
    END_TOKEN,
    EOS_TOKEN,
    MIN_ASCII_RATIO,
    MIN_COMMON_WORDS,
    MIN_DISTINCT_WORDS,
    USER_TOKEN,
    WS_CHARS,
    WS_JAVA,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(text: Column | str) -> Column:
    """Strip Unicode whitespace on both ends (``trim`` would remove spaces only)."""
    return F.btrim(_col(text), F.lit(WS_CHARS))


def collapse_ws(text: Column | str) -> Column:
    """Each run of whitespace becomes one space; none is left at the ends."""
    return F.btrim(F.regexp_replace(_col(text), f"{WS_JAVA}+", " "))


def clean(text: Column | str) -> Column:
    """Null becomes empty, then whitespace is collapsed."""
    return collapse_ws(F.coalesce(_col(text), F.lit("")))


def render_chat(user: Column | str, assistant: Column | str) -> Column:
    return F.concat(F.lit(USER_TOKEN), _col(user), F.lit(ASSISTANT_TOKEN), _col(assistant),
                    F.lit(END_TOKEN))


def render_open_prompt(user: Column | str) -> Column:
    return F.concat(F.lit(USER_TOKEN), _col(user), F.lit(ASSISTANT_TOKEN))


def ascii_ratio(text: Column | str) -> Column:
    """Share of code points below 128; null for an empty text."""
    text = _col(text)
    n = F.char_length(text)
    n_other = F.char_length(F.regexp_replace(text, r"[\x00-\x7f]+", ""))
    return (n - n_other) / F.nullif(n, F.lit(0))


def word_set(text: Column | str) -> Column:
    """Distinct lower-case words; apostrophes belong to words."""
    return F.array_distinct(
        F.regexp_extract_all(F.lower(_col(text)), F.lit("[a-z']+"), F.lit(0)))


def looks_english(text: Column | str) -> Column:
    """Mostly ASCII, and two of the common words or five different words."""
    text = _col(text)
    words = word_set(text)
    common = F.array_intersect(words, F.array(*[F.lit(w) for w in COMMON_WORDS]))
    return (
        (F.coalesce(F.char_length(text), F.lit(0)) > 0)
        & (F.coalesce(ascii_ratio(text), F.lit(0.0)) >= MIN_ASCII_RATIO)
        # Nearly every text passes on its number of words, so that is looked at first.
        & ((F.size(words) >= MIN_DISTINCT_WORDS) | (F.size(common) >= MIN_COMMON_WORDS))
    )


def ellipsis(text: Column | str, width: int, mark: bool = True) -> Column:
    """First ``width`` characters, followed by `` ...`` when something was cut."""
    text = _col(text)
    head = F.substring(text, 1, width)
    if not mark:
        return head
    return F.when(F.char_length(text) > width, F.concat(head, F.lit(" ..."))).otherwise(text)


def cut_at_id(ids: Column | str, stop_id: int | Column) -> Column:
    """Ids before the first ``stop_id``; unchanged when it does not occur."""
    ids = _col(ids)
    stop = stop_id if isinstance(stop_id, Column) else F.lit(stop_id)
    at = F.array_position(ids, stop).cast("int")
    return F.when(at > 0, F.slice(ids, F.lit(1), at - 1)).otherwise(ids)


def strip_eos_text(text: Column | str) -> Column:
    return py_strip(F.replace(_col(text), F.lit(EOS_TOKEN), F.lit("")))


def seed_empty_prompt(ids: Column | str, eos_id: int | None) -> Column:
    """An empty prompt becomes one seed token: EOS if there is one, else id 0."""
    ids = _col(ids)
    return F.when(F.size(ids) == 0, F.array(F.lit(0 if eos_id is None else eos_id))).otherwise(ids)
