"""The named queries of the operators, each with SQL for the same rows where SQL can say it."""

from __future__ import annotations

from hybridframe.llm import (  # noqa: F401
    bpe, langid, lexical, licenses, lines, mixing, quality, radix, shards, simhash, suffixes, tokencounts, variants,
)
from hybridframe.llm.common import QUERIES, SQL  # noqa: F401
