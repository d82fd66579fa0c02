"""The package run on the given tables, with SQL to compare the results to.

``views``    domain tables derived from the given tables
``queries``  one query per operator
``oracle``   the same answers in SQL
"""
