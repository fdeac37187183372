"""shelfwise: pricing and inventory decision analytics as Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` function built from native
Spark expressions, windows, aggregates and joins.  Sub-packages:

* ``sources``   – readers for the driver tables, the panel adapter, decision sinks
* ``functions`` – reusable column expressions (rounding, safe division, erf, rules)
* ``operators`` – features, demand, elasticity, pricing, inventory, joint, backtest, reports
* ``plans``     – composed pipelines (decision pipeline, scenarios) and the query registry
* ``streaming`` – the stateless row operators applied to a streaming DataFrame
"""

__version__ = "0.1.0"
