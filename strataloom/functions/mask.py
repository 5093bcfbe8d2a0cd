"""The file mask: which paths hold source that can be tokenized."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the mask of the sources that can be tokenized.
UNIVERSAL = "(?i)\\.(c|c\\+\\+|cc|cp|cpp|cxx|h|h\\+\\+|hh|hpp|hxx|java|rs|tcc)$"


def mask_of(extensions: Iterable[str]) -> str:
    """A case-insensitive pattern of the paths that end in a dot and one of ``extensions``, whatever signs these hold; none at all is an error."""
    branches = "|".join(sorted({re.escape(e) for e in extensions}))
    if not branches:
        raise ValueError("no extension to select by")
    return "(?i)" + re.escape(".") + f"({branches})" + "$"


def selects(path: Column, mask: str = UNIVERSAL) -> Column:
    """Whether ``mask`` is found in ``path``. A blank mask means the universal one."""
    return path.rlike(mask or UNIVERSAL)
