"""storyloom: a Spark-native news selection and digest engine.

Articles from landed feeds, search results and pages are normalised,
filtered, scored, grouped into stories by a distributed title-similarity
join, ranked by how many distinct sources carry each story, and rendered
as a digest. Every stage is a ``DataFrame -> DataFrame`` transformation
that runs unchanged in batch jobs and in Structured Streaming.
"""

from storyloom.params import DigestParams

__all__ = ["DigestParams"]
