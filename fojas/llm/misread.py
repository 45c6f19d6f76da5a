"""What recognition does to letters: skeletons under which a misread word and its source are equal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fojas.functions.reading import ACCENTED, PLAIN

# Letters that are read as two (upper case). Writing them out, instead of joining the two, leaves no choice where strokes overlap.
WRITTEN_OUT = {"M": "RN", "W": "VV", "U": "LI"}
# Characters read for one another, and the one that stands for them all (upper case).
SAME_SHAPE = {"0": "O", "Q": "O", "D": "O", "1": "I", "L": "I", "|": "I", "!": "I", "5": "S", "4": "A", "3": "E", "€": "E", "8": "B", "6": "G", "9": "G", "2": "Z", "+": "T", "7": "T"}


def skeleton(c: Column) -> Column:
    """Upper-case skeleton as a column expression; accents fall away."""
    s = F.translate(F.upper(c), ACCENTED, PLAIN)
    for one, pair in WRITTEN_OUT.items():
        s = F.replace(s, F.lit(one), F.lit(pair))
    return F.translate(s, "".join(SAME_SHAPE), "".join(SAME_SHAPE.values()))


_ACCENTS = str.maketrans(ACCENTED, PLAIN)
_TABLE = str.maketrans(SAME_SHAPE)


def skeleton_text(text: str) -> str:
    """The same for a Python string."""
    s = text.upper().translate(_ACCENTS)
    for one, pair in WRITTEN_OUT.items():
        s = s.replace(one, pair)
    return s.translate(_TABLE)
