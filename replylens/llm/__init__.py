"""Operators for preparing training data, each a function `DataFrame -> DataFrame`.

Nothing outside this package imports it. `queries.QUERIES` registers one query per operator and
`sql.ORACLES` has the SQL of those that SQL can express.
"""
