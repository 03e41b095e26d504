"""layerworks: layered analytical tables on stock PySpark.

Raw feeds land as text with provenance (bronze), are conformed to typed,
latest-record-wins rows with a quarantine for rejects (silver), and feed a star
schema with hashed surrogate keys, a key-merged fact and a monthly aggregate
(gold). Table versions, time travel and change reports are DataFrame
operators over a version changelog. A quality gate blocks publication.

Every operator is a DataFrame -> DataFrame function; nothing runs outside
Spark's planner.
"""

__version__ = "0.1.0"
