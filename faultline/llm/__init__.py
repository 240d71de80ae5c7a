"""Operators for preparing training data at scale.

One module per operator; ``registry`` lists their queries. Nothing outside
this package (and ``corpus_pipeline.py``) imports it.
"""
