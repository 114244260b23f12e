"""SQL expressions shared by the operators, as text.

A profile of a wide table has hundreds of expressions. As text they reach the
JVM in one call per projection, and Catalyst sees the same tree.
"""
