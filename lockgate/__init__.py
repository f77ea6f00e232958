"""lockgate: move sets of tables to a new layout and namespace on Spark, and prove nothing was lost.

functions   column expressions (no Python UDF anywhere)
sources     readers, writers and the shared scratch folder
operators   DataFrame -> DataFrame steps: profile, compat, mapping, move, viewsql, grants, reconcile, rollback, reports
plans       synthetic bureau tables, the analytic views and the end-to-end migration run
"""
