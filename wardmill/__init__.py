"""Spark-native jobs for clinical messages, patient documents and execution logs."""
