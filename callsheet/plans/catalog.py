"""All registered queries."""

from __future__ import annotations

from callsheet.plans import queries_contacts, queries_urls  # noqa: F401
from callsheet.plans import queries_extra, queries_reports  # noqa: F401
from callsheet.plans.queries_reports import contacts_from_texts  # noqa: F401
from callsheet.plans.registry import QUERIES, SQL  # noqa: F401
