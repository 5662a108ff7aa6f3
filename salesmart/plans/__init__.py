"""Plans over the operators.

views     every stage as a lazy DataFrame over a set of raw datasets
pipeline  setup / ingest / quality / enrich / mart / reports / run_pipeline
"""
