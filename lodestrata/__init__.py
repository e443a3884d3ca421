"""Analytics over UTXO-style transaction ledgers, on PySpark DataFrames."""
