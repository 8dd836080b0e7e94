"""DataFrame -> DataFrame operators, grouped by family.

profile   A1-A15, S3, S5, P8-P11   column profiling
prep      F1-F14                   splits, encoders, scalers, pipeline
models    M1-M16                   pyspark.ml regressors and helpers
ensemble  N1-N7                    averaging, weights, stacking, blending
tune      H1-H7, W1, W2, S4        search and trial analysis
evaluate  E1-E17                   metric and diagnostic tables
frames    P1-P7, P12, J1-J4        projections, keyed concat, lookups
"""
