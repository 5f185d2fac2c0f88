"""Query plans over the given tables. Importing the package fills the registry."""

from fieldlens.plans import (catalog_views, cleaning, descriptive, models, outputs,  # noqa: F401
                             quality_checks, sql_reports, statistics, streams)
