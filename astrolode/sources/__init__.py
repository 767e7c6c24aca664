"""File sources and sinks; every path is a URI of any file system Spark can reach."""
