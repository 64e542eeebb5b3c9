"""Training-data operators for text corpora: one module per operator, plus
``registry`` with their queries.  Nothing else in the library imports this
subpackage."""
