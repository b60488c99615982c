"""riskstream: payment-fraud signals, risk scores and cases on Spark.

Operators are functions ``DataFrame -> DataFrame`` (``riskstream.operators``),
composed into views by ``riskstream.plans.views.Views`` and kept current from
streams by ``riskstream.streaming.topology``.
"""
