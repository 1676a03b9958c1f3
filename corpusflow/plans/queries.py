"""All registered queries and their SQL twins, by name."""

from __future__ import annotations

from corpusflow.plans import catalog, formats, more, speech

#: Each module adds its own to these as it is imported.
MODULES = (catalog, formats, more, speech)
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES
