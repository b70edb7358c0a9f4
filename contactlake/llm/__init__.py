"""Training-data operators: thirteen corpus operators and their registered queries.

Every operator takes a DataFrame with any extra columns and returns ``(row, out)`` or its
own documented columns: ``row`` is the untouched input row as a struct, ``out`` the
operator's result, so no input column name can clash with a result name.
"""
