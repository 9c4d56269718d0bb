"""airlens: EPA air-quality analytics as plain Spark DataFrame functions.

Every public function takes and returns DataFrames (or Columns); none
creates a session. ``airlens.session.build_session`` is a convenience for
scripts and tests.
"""

__version__ = "0.1.0"
