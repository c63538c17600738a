"""Training-data operators.

Each module holds one operator with a general interface; ``queries`` holds the
registered ``opN_<name>`` queries and their SQL.  Nothing outside this folder
imports it.
"""
