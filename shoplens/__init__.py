"""shoplens: shop-interaction analytics on Spark.

Raw ratings + item metadata -> typed interaction table -> user profiles ->
segments -> cosine kNN baseline + random-forest ranker -> threshold tuning ->
top-N unseen items per user.  Every operator takes and returns DataFrames.
"""

__version__ = "0.1.0"
