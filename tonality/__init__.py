"""tonality: sentiment analytics on Spark.

Comments are cleaned and tokenized with native column expressions, turned
into vectors (TF-IDF or a hashed bag of words), split reproducibly, scored
by Naive Bayes, logistic regression or random forest models, and reported
on with aggregates. Public entry points are DataFrame -> DataFrame
functions; see ``tonality.api``.
"""

__version__ = "0.1.0"
