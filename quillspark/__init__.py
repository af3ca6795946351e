"""quillspark: text features and linear models as Spark DataFrame plans.

Layout
------
sources/    line-marked documents, headerless CSV (plain or bz2), the test tables
functions/  column expressions: tokens, safe casts, sparse dot products, losses
operators/  cleaning, closed-form regression, vocabulary and TF-IDF, class
            profiles, fused gradients, metrics
plans/      driver loops (gradient descent with step and stop rules, classifiers)
            and the registered query catalog with its SQL oracles
llm/        operators for training-data pipelines (optional; nothing else imports it)
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Serialise this package's functions by value in Spark task closures.

    The Arrow passes (gradient, featuriser, densifier) call helpers defined in
    this package; pickled by reference, every Python worker would need the
    package installed. By value, the code travels with the task."""
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pyspark absent: nothing to ship
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
