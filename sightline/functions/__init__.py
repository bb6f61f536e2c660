"""Column -> Column functions; everything here stays on the JVM side except the vector UDF."""
