"""layerflow: layered review data on Spark.

Pages of JSON documents and reference CSV files become a document store, a
raw layer (discovered schema, shredded child tables), a clean layer, a
constraint-gated relational layer, a data-quality report and a star schema,
each published as a versioned set of tables. See README.md.

Subpackages: ``functions`` (Column expressions), ``sources`` (pages, CSV,
layer store), ``operators`` (schema, shredding, upserts, keys, cleaning,
relational, checks, star), ``plans`` (the daily job and the registered
queries), ``streaming`` (page stream upsert).
"""

__version__ = "0.1.0"
