"""Training-data operators: deduplication, filtering, archiving and packing.

Nothing else in the package imports this subpackage.  Like the parent
package, worker-side functions are pickled by value, so executors need no
installed copy.
"""
