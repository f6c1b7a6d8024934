"""corpusforge: Spark-native corpus indexing.

Turns text and web corpora into a paired *meta* table (where each
document's raw bytes live) and *data* table (searchable fields), keyed by
one deterministic ``_id``; plus byte offsets, HTML/URL/text extraction,
quality filters, analyzers, postings and BM25 retrieval.

Every public function takes and returns ``Column`` or ``DataFrame``.
"""

from corpusforge.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
