"""Operators of a training-data pipeline: secrets, nearest neighbours, near duplicates,
licences, chat formatting, personal data, toxicity, repeated passages, benchmark
decontamination and packing.

``queries`` registers one query per operator; nothing outside this folder imports it
except the guarded lines of ``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
