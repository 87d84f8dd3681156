"""shopshift: move shop data between data models with Spark DataFrames.

Layout
------
sources/    reading tables, literal lookups, staging, read-back of written tables
sinks/      conforming to target schemas, unions, snapshot refresh/replace, reset
functions/  Column helpers (text parsing, SKUs, serialised options) and predicates
operators/  keys, code lookups, EAV unpivot, reshapes, class pivot, updates, joins
plans/      the migration jobs (customers, addresses, products, orders, reviews, ...)
streaming/  intentionally empty: the migration is a batch job
"""

__version__ = "0.1.0"
