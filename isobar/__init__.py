"""isobar — a Spark-native engine for observation / forecast analytics.

Raw nested JSON lands, is normalised into keyed tables where the newest
delivery wins per key, past forecasts are scored against what was later
observed, and the error spread turns the newest forecast into 95 % bands.
Everything is expressed as DataFrame / SQL plans so Catalyst and AQE choose
the physical strategy.

Entry points: ``isobar.plans.jobs`` (normalise / rebuild / analyse / report /
hourly cycle, streamed normalise and speed layer), ``python -m isobar`` for
the same from a command line, and the operator modules under
``isobar.operators`` / ``isobar.functions`` for use in one's own plans.
"""

__version__ = "0.1.0"
