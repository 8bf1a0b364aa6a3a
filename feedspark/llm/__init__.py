"""Training-data operators: quality, deduplication, language, mixing, search
and tokenization of document tables. Nothing else in the library imports this
subpackage; ``llm.registry`` holds its queries and ``llm.oracle`` their SQL."""
import sys

from pyspark import cloudpickle

# functions sent to tasks travel whole: executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
