"""Training-data operators over document collections.

Nothing else in the library imports this subpackage; it may import general
helpers of the library (scratch folders).  ``registry`` holds its queries.
"""
