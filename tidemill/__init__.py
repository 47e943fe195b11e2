"""tidemill: analytics jobs written as Spark DataFrame plans."""
