"""bourse: a Spark-native market-data engine.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function. Nothing is collected to the driver inside an operator; Catalyst and
AQE pick the physical strategy.
"""

__version__ = "0.1.0"
