"""Form-corpus analytics as Spark DataFrame operators.

Every public function takes and returns DataFrames or Columns.  The unit of
work is a whole corpus: layouts are keyed by ``(form_id, page)``, records by
``case_id`` or ``record_id``, texts by ``doc_id``.
"""

__version__ = "0.1.0"
