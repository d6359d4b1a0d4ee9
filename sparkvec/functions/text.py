"""Text columns: windows, cleaning, previews, word sets."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what the encoder sees instead of blank text.
EMPTY_TEXT = "[EMPTY]"

# Unicode-aware whitespace, the same class that Python's str.split() uses for
# ordinary text. Java's plain \s is ASCII only.
#: Characters of windows that a task holds of one text.
STRETCH_CHARS = 4 << 20
SPACES = r"(?U)[\s\x1c-\x1f]+"
NOT_SPACE = r"(?U)[^\s\x1c-\x1f]"


def check_window(chunk_size: int, overlap: int) -> None:
    """A window must advance: ``0 <= overlap < chunk_size`` when windows are on."""
    if chunk_size > 0 and not 0 <= overlap < chunk_size:
        raise ValueError(f"overlap {overlap} must be in 0..{chunk_size - 1}")


def window_count(length: Column, chunk_size: int, overlap: int, emit_tail: bool = False) -> Column:
    """How many windows a text of this length has."""
    check_window(chunk_size, overlap)
    if chunk_size <= 0:
        return F.lit(1)
    step = chunk_size - overlap
    covered = F.ceil(length / F.lit(step)) if emit_tail else (
        F.ceil((length - F.lit(chunk_size)) / F.lit(step)) + 1
    )
    return F.when(length <= chunk_size, F.lit(1)).otherwise(covered.cast("int"))


def text_windows(
    text: Column, chunk_size: int, overlap: int = 0, emit_tail: bool = False
) -> Column:
    """Array of overlapping character windows of a text.

    The text is cut once into blocks of one step each, and every window is put
    together from neighbouring blocks. ``substring`` at a growing offset would
    walk the text from its start for every window, which is quadratic for long
    documents.
    """
    check_window(chunk_size, overlap)
    if chunk_size <= 0:
        return F.array(text)
    count = window_count(F.length(text), chunk_size, overlap, emit_tail)
    windows = first_windows(text, count, chunk_size, overlap)
    return F.when(F.length(text) <= chunk_size, F.array(text)).otherwise(windows)


def first_windows(text: Column, count: Column, chunk_size: int, overlap: int) -> Column:
    """The first ``count`` windows, which must be at least one."""
    step = chunk_size - overlap
    span = math.ceil(chunk_size / step)
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))

    def join_blocks(cut: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), count - F.lit(1)),
            lambda k: F.substring(
                F.array_join(F.slice(cut, k + F.lit(1), F.lit(span)), ""), 1, chunk_size
            ),
        )

    # The one-element array binds the cut blocks to a name, so that they are
    # computed once per text and not once per window.
    return F.element_at(F.transform(F.array(blocks), join_blocks), 1)


def windows_per_stretch(chunk_size: int, overlap: int) -> int:
    """How many windows are held at a time, however long a text is: about ``STRETCH_CHARS`` characters of them."""
    return max(math.ceil(chunk_size / (chunk_size - overlap)), STRETCH_CHARS // chunk_size)


def stretches(text: Column, chunk_size: int, overlap: int) -> Column:
    """Array of pieces of a text that hold the windows starting in them: each runs ``overlap`` characters into the next."""
    length = windows_per_stretch(chunk_size, overlap) * (chunk_size - overlap)
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{length}}}"), F.lit(0))

    def run_on(pieces: Column) -> Column:
        def longer(piece: Column, at: Column) -> Column:
            following = F.coalesce(F.get(pieces, at + F.lit(1)), F.lit(""))
            return F.concat(piece, F.substring(following, 1, overlap))

        return F.transform(pieces, longer)

    long = F.element_at(F.transform(F.array(cut), run_on), 1)
    return F.when(F.length(text) > length, long).otherwise(F.array(text))


def sanitize_text(text: Column) -> Column:
    """Drop NUL characters, squeeze whitespace to single blanks, trim."""
    without_nul = F.replace(text, F.lit("\x00"), F.lit(""))
    return F.trim(F.regexp_replace(without_nul, SPACES, " "))


def is_blank(text: Column) -> Column:
    """Null or nothing but whitespace. Stops at the first other character."""
    return F.coalesce(~text.rlike(NOT_SPACE), F.lit(True))


def encoder_input(text: Column) -> Column:
    """Sanitized text, or the placeholder where nothing is left."""
    clean = F.coalesce(sanitize_text(text), F.lit(""))
    # One expression, as a CASE over the cleaned text would clean it twice.
    return F.regexp_replace(clean, r"\A\z", F.lit(EMPTY_TEXT))


def preview(text: Column, length: int, ellipsis: str = "") -> Column:
    """The first characters, with an ellipsis only where something was cut."""
    head = F.substring(text, 1, length)
    if not ellipsis:
        return head
    return F.when(F.length(text) > length, F.concat(head, F.lit(ellipsis))).otherwise(text)


def words(text: Column) -> Column:
    """Lower-cased whitespace-separated words, in order."""
    return F.filter(F.split(F.lower(text), SPACES), lambda w: w != "")


def word_set(text: Column) -> Column:
    return F.array_distinct(words(text))
