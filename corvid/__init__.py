"""corvid: text-classification, chat and bank-statement data work on Spark.

Every operator takes and returns DataFrames; nothing is collected to the driver
except bounded constants (label maps, pattern tables, top-k vocabularies).
"""

__version__ = "0.1.0"
