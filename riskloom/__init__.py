"""riskloom: clinical risk analytics written as Spark DataFrame jobs.

Cleans and profiles patient tables, derives disease features as column
expressions, scores whole patient tables against 20 disease panels, ranks
differentials, triages, evaluates and trains MLlib classifiers.
"""

__version__ = "0.1.0"
