"""All named queries and their SQL."""

from __future__ import annotations

from routeloom.plans import control, pages, routes, strokes, workflow

QUERIES = {**control.QUERIES, **routes.QUERIES, **pages.QUERIES, **strokes.QUERIES, **workflow.QUERIES}
ORACLES = {**control.ORACLES, **routes.ORACLES, **pages.ORACLES, **strokes.ORACLES, **workflow.ORACLES}
