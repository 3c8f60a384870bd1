"""Readers, writers and request payloads. Paths may be local, ``hdfs://``, ``s3a://`` … alike."""
