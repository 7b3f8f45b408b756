"""Address labels: the parts of an address, each on lines of its own."""

from __future__ import annotations

import re
import textwrap

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a PO box and a unit look like in a label, and the signs that may hang on to what is left.
BOX = r"P\s*\.?\s*O\s*\.?\s*B\s*O\s*X\s+\S+"
UNIT = r"\b(?:STE|APT|UNIT(?:\s+(?:NO\.?|NUM))?|SUITE)\s+#?\s*[^\s#]+"
EDGE = ",%&"

_BOXED = re.compile(f"(?P<box>{BOX})", re.IGNORECASE)
_UNITED = re.compile(f"(?P<street>.*?{UNIT})\\s+(?P<tail>\\S.*)")
#: The order of the parts on a label.
LAYOUT = ("box", "beside", "street", "tail", "lead")


def parts(raw: str, normal: str) -> dict[str, str]:
    """What an address consists of. With a PO box: ``box`` and what stands ``beside`` it (in the raw text, if the box is
    there too). Else the ``street`` up to its unit, the ``tail`` behind the unit, and the ``lead``: words of the raw text
    before the house number that the normalized address does not hold."""
    if boxed := _BOXED.search(normal):
        carrier = raw if _BOXED.search(raw) else normal
        return {"box": boxed["box"], "beside": " ".join(_BOXED.sub("", carrier, count=1).split()).strip(EDGE)}
    united = _UNITED.fullmatch(normal)
    out = united.groupdict() if united else {"street": normal}
    house = re.match(r"\d+", normal)
    before, *behind = re.split(rf"\b{house[0]}\b", raw, maxsplit=1) if house else [""]
    lead = before.strip().rstrip(EDGE) if behind else ""
    return out | {"lead": "" if lead in normal else lead}


def label(raw: str | None, normal: str | None, width: int = 45) -> str:
    """The parts in the order of LAYOUT, wrapped to lines of ``width``."""
    found = parts((raw or "").strip().upper(), (normal or "").strip())
    return "\n".join(line for kind in LAYOUT for line in textwrap.wrap(found.get(kind, ""), width))


@F.pandas_udf(T.StringType())
def address_label(raw: pd.Series, normal: pd.Series) -> pd.Series:
    return pd.Series([label(r, n) for r, n in zip(raw, normal, strict=True)])
