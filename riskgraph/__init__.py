"""PySpark-native engine for governed, graph-shaped risk analytics.

Layers:

* ``functions``  - ``Column -> Column`` builders (parsers, predicates, IRIs, vectors)
* ``operators``  - ``DataFrame -> DataFrame`` operators (contracts, triples, patterns, metrics)
* ``sources``    - snapshots, tables, N-Triples, reports
* ``streaming``  - incremental ingest that reuses the batch contracts
* ``plans``      - bindings of operators to concrete tables, and the query registry
"""
