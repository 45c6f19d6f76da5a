"""Document-field analytics on Spark: texts and field readings in, consolidated records and corpus tables out."""
