"""gridmart: hourly observation integration expressed with Spark DataFrames.

Layers (bronze -> silver -> gold), data-quality checks and analytics are plain
functions from DataFrame to DataFrame.  All execution is left to Spark SQL
(Catalyst, AQE, whole-stage codegen); nothing here plans or executes queries
on its own.

Subpackages
-----------
functions   column expressions (time parsing, hour keys, predicates)
sources     landing-file readers and table layout / writers
operators   reusable DataFrame operators (roll-up, joins, upsert, gaps, grids,
            profiles, quality checks, marks)
plans       the layer transforms, gold build/increment, jobs and analytics
streaming   Structured Streaming forms of ingest and the hourly roll-up
"""

__all__ = ["session", "schemas"]
