"""All queries of the core, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from specloom.plans import carriers, catalog, composed, crawl, evidence, flow, gathered, problems

QUERIES = {**problems.QUERIES, **crawl.QUERIES, **catalog.QUERIES, **flow.QUERIES, **evidence.QUERIES, **carriers.QUERIES, **composed.QUERIES, **gathered.QUERIES}
ORACLE = {**problems.ORACLE, **crawl.ORACLE, **catalog.ORACLE, **flow.ORACLE, **evidence.ORACLE, **carriers.ORACLE, **composed.ORACLE, **gathered.ORACLE}
