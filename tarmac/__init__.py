"""tarmac: cleaning, joining and reporting on journey, booking, customer and payment tables with PySpark."""
