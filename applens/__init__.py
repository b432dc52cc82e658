"""applens: app-catalogue and review analytics as Spark DataFrame operators.

Every public function takes DataFrames (and plain parameters) and returns a
lazy DataFrame; no function creates or stores a session. Sub-packages:

* ``sources``   readers/writers for catalogue, feature and review data, plus
                the stand-in inputs derived from the driver tables
* ``functions`` column expressions (text parsing, labels, rounding)
* ``operators`` filters, aggregates, profiles, joins, windows, encoders,
                models and lexicon sentiment
* ``plans``     the composite jobs (clean, features, rollup, profile, model,
                review sentiment and report)
* ``streaming`` the stateless cleaning steps applied to a streaming source
"""

__version__ = "0.1.0"
