"""postlake: a PySpark-native lakehouse toolkit for posting-style feeds."""
