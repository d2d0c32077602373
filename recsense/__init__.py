"""Spark-native operators that distill multichannel sensor logs into per-row calls."""
