"""PySpark-native analytics over community discussions: every operator is DataFrame(s) in, DataFrame out."""
