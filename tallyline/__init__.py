"""A PySpark-native sequence-ledger analytics engine."""
