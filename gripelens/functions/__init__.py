"""Column expressions; all run in the JVM (array lambdas outside generated code), none uses Python workers."""
