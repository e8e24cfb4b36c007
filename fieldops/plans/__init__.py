"""K — business computations: parameterised DataFrame -> DataFrame functions.

Every function takes its "today" as ``as_of`` (never ``current_date()``), so reruns and tests are
reproducible.
"""
