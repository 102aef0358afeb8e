"""Jobs, domain tables and registered queries."""

from . import files, further, hulls, models, outcomes, palettes, planted, queries  # noqa: F401  (each registers its queries)
