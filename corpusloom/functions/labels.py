"""Reading stored language labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import small


def reads_as(label: Column, languages: DataFrame) -> Column:
    """Code of the language that a stored label reads as, else NULL; `languages` is a table of fixed size."""
    forms: dict[str, str] = {}
    rows = small(languages.select("lang", "code2", "lang_name"), 10_000)
    for pick in ("lang", "code2", "lang_name"):
        for r in rows:
            if r[pick] is not None:
                forms.setdefault(r[pick].strip().lower(), r["lang"])
    table = F.create_map(*[F.lit(x) for kv in sorted(forms.items()) for x in kv])
    plain = F.lower(F.trim(label))
    return F.coalesce(F.try_element_at(table, plain), F.try_element_at(table, F.regexp_extract(plain, r"^([^-_]*)", 1)))
