"""Column functions; nothing here touches a DataFrame or leaves the JVM."""
