"""limnia: lake and climate time series on Spark DataFrames.

Layers, from small to large:

- ``functions``  column expressions (no shuffle, no action)
- ``sources``    scans, sinks, file manifests
- ``operators``  DataFrame -> DataFrame building blocks
- ``plans``      whole pipelines built from the operators
- ``streaming``  the daily extraction as an incremental file stream
"""
