"""quire: turn book collections into study cards with Spark DataFrame operators.

Sub-packages:
  functions  row-local Column functions (text, HTML, JSON replies)
  sources    table readers, the book file catalog and the test fixture views
  operators  DataFrame -> DataFrame operators (segmentation, suitability,
             cards, reports, exports)
  plans      end-to-end plans and the query registry used by the driver
  streaming  the row-local operators on streaming inputs
"""

__version__ = "0.1.0"
