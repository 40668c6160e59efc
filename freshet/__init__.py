"""freshet: Spark jobs that keep status tables current.

Two job families live here, both written against the DataFrame / SQL API:

* the weather status refresh: landed HTTP responses and two-line text logs
  become typed tables, and a keyed status table is updated from them
  without ever inserting unknown keys (batch and Structured Streaming);
* the renewal job: pick the latest version per entity, select what needs
  renewing, number it and cut it into commit batches, apply conditional
  updates as new table snapshots and write audit rows per stage.
"""

__version__ = "0.1.0"
