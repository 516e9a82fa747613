"""The query catalogue, by topic.  Importing this package registers every query."""

from tidegrid.plans.catalog import (aggregates, blocks, fetching, grids, identity, indexed,  # noqa: F401
                                    records, stores, streams, vectors)
