"""linecraft: line-oriented text and log analytics as Spark DataFrame operators.

Sub-packages: ``functions`` (column expressions), ``sources`` (text, event
logs, tables), ``operators`` (DataFrame → DataFrame), ``sinks`` (file
writes), ``plans`` (whole jobs and the registered queries) and ``streaming``
(the same operators over file streams).
"""

__version__ = "0.1.0"
