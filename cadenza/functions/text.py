"""Column functions on transcripts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character classes of the transcripts.
TERMINAL = "。！？；：、，!?;:,~—…"
MID = "，,、；;：:—"
FIN = "。！？!?…~～."
CHINESE = "一-鿿"
KEPT = CHINESE + "㐀-䶿A-Za-z0-9"
COUNTED = CHINESE + "A-Za-z0-9"


def has_chinese(text: Column) -> Column:
    return text.rlike(f"[{CHINESE}]")


def strip_space(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def strip_punct(text: Column) -> Column:
    """Letters and digits only, including the first extension block."""
    return F.regexp_replace(text, f"[^{KEPT}]", "")


def n_chars(text: Column) -> Column:
    """Characters that count for the speech rate; the extension block doesn't."""
    return F.length(F.regexp_replace(text, f"[^{COUNTED}]", "")).cast("long")


def boundary(between: Column) -> Column:
    """fin, mid or none: the strongest mark in the text between two words."""
    return F.when(between.rlike(f"[{FIN}]"), "fin").when(between.rlike(f"[{MID}]"), "mid").otherwise("none")


def join_texts(parts: Column) -> Column:
    """Parts put together in order; a half-width comma where no terminal mark stands. Empty parts are left out."""
    clean = F.filter(F.transform(parts, strip_space), lambda x: x != "")

    def add(done: Column, x: Column) -> Column:
        closed = F.instr(F.lit(TERMINAL), F.right(done, F.lit(1))) > 0
        return F.when(done == "", x).when(closed, F.concat(done, x)).otherwise(F.concat(done, F.lit(","), x))

    return F.aggregate(clean, F.lit(""), add)


def tail_mark(text: Column, forced: Column) -> Column:
    """A full stop at the end becomes a half-width comma where the cut was forced."""
    return F.when(forced & strip_space(text).endswith("。"), F.regexp_replace(text, r"(?U)。\s*$", ",")).otherwise(text)
