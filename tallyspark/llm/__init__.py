"""Operators for large-scale training-data pipelines (queries ``op1_`` .. ``op10_``)."""
