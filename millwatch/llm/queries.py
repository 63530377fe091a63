"""All queries of the subpackage."""

from __future__ import annotations

from . import on_conversations, on_documents, on_pages  # noqa: F401
from .catalog import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
