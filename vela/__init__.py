"""vela: versioned data and model analytics as Spark jobs.

Sub-packages
------------
functions  reusable Column expressions (hash uniforms, samplers, version keys)
sources    driver tables, synthetic generators, snapshot tables
operators  features, metrics, training, scoring, version logs, lineage
plans      end-to-end workflows and the registered query catalogue
streaming  Structured Streaming scoring and counters
"""

__version__ = "0.1.0"
