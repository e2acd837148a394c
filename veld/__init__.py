"""veld: Spark-native data preparation and regression for wide listing tables.

Every operator is a function ``DataFrame -> DataFrame`` or a fit/transform pair whose
fitted statistics are small DataFrames or plain Python values computed by one
distributed aggregation.  Sub-packages:

* ``veld.sources``   - readers, writers, lookup-table loading, model persistence
* ``veld.functions`` - Column expressions (text, numeric, geographic)
* ``veld.operators`` - cleaning, profiling, quantiles, encoders, geo joins, selection
* ``veld.plans``     - models, evaluation, search and the end-to-end flows
* ``veld.streaming`` - scoring fitted pipelines on streaming DataFrames
"""

from veld.session import get_session, checkpoint_root, materialize

__all__ = ["get_session", "checkpoint_root", "materialize"]
