"""Spark-native news-feed analytics: every transform is a lazy DataFrame -> DataFrame function."""
