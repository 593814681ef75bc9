"""Operators for preparing training text, and the queries that apply them.

Nothing else in the library imports this subpackage. Importing it registers its queries in
``latebook.llm.registry``; operators take and return DataFrames and share these rules:

* a null text counts as empty, null in any other column is an ordinary value;
* rows that agree in ``doc_id`` and text are one document, told apart nowhere;
* columns an operator does not read pass through or are left out as its docstring says, and
  helper columns carry a ``_lb_`` prefix, so that extra columns with any name do no harm.
"""
